"""Clustering over approximations against plain Lloyd steps."""

import hashlib
import math
import random

import numpy as np
import pytest
from oracle import difference

from tillstream.llm import vafile
from tillstream.llm.queries import ORACLE, QUERIES

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "looked_at"]


def plain(rows, dims, k, rounds):
    """(id, cluster, distance, cluster's sum, sum, digest) of each usable row, every distance worked out in Python integers."""
    own = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
           if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in own if i is not None)
    centroids = [v for _, v in named[:k]]
    if not centroids:
        return []

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in own]

    for _ in range(rounds):
        found = assigned()
        for n in range(len(centroids)):
            members = [v for (_, v), (_, c) in zip(own, found, strict=True) if c == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = assigned()
    sums = {n: sum(d for d, c in found if c == n) for n in range(len(centroids))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, sums[c], sum(sums.values()), names[c]) for (i, _), (d, c) in zip(own, found, strict=True)]


def made(seed, n, dims):
    """Vectors around a few centres, many equal ones, ties, and those that are left out."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(1000 + i, [0.25] * dims) for i in range(n // 2)]
    rows += [(2000 + i, [rng.choice([-0.5, 0.5]) for _ in range(dims)]) for i in range(n // 2)]
    rows += [(3, [0.1] * dims), (3, [0.2] * dims), (None, [0.3] * dims), (None, [0.3] * dims)]
    rows += [(4000, None), (4001, []), (4002, [0.1] * (dims - 1)), (4003, [0.1] * (dims + 1)), (4004, [None] + [0.1] * (dims - 1)),
             (4005, [float("nan")] + [0.1] * (dims - 1)), (4006, [float("-inf")] + [0.1] * (dims - 1))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "dims", "bits"), [(1, 8, 6), (2, 5, 2), (3, 64, 8)])
def test_against_plain_steps(spark, seed, dims, bits):
    rows = made(seed, 120, dims)
    table = spark.createDataFrame([(i, e, 0, "x") for i, e in rows], "vec_id long, embedding array<double>, cluster int, v string").repartition(5)
    found = vafile.clusters(table, dims=dims, k=7, rounds=4, bits=bits)
    assert found.columns == COLUMNS
    assert sorted((tuple(r)[:6] for r in found.collect()), key=repr) == sorted(plain(rows, dims, 7, 4), key=repr)


def test_few_and_no_vectors(spark):
    rows = [(5, [0.5, 1.0]), (6, [0.0, -1.0]), (None, [0.5, 0.9])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = vafile.clusters(table, dims=2)
    assert sorted((tuple(r)[:6] for r in found.collect()), key=repr) == sorted(plain([(i, [float(np.float32(x)) for x in e]) for i, e in rows], 2, 40, 5), key=repr)
    for empty in (table.where("false"), table.where("vec_id is null"), spark.createDataFrame([(1, None)], table.schema)):
        none = vafile.clusters(empty, dims=2)
        assert none.columns == COLUMNS and none.count() == 0


def test_large_components_are_bounded(spark):
    table = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [1e299, 0.5])], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vafile.clusters(table, dims=2, k=2, rounds=1).collect()}
    assert found[1].cluster == found[3].cluster != found[2].cluster and found[2].distance == 0


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_open_centroids_hold_all_nearest_ones(bits):
    rng = np.random.default_rng(bits)
    vectors = rng.integers(-60, 60, (500, 9))
    cuts = np.quantile(vectors, [k / 2**bits for k in range(1, 2**bits)], axis=0, method="lower").T.astype(np.int64)
    low = np.concatenate([vectors.min(axis=0)[:, None], cuts], axis=1)
    high = np.maximum(np.concatenate([cuts - 1, vectors.max(axis=0)[:, None]], axis=1), low)
    cells = vafile.Cells(low, high, bits)
    bytes_ = cells.approximate(vectors)
    assert bytes_.shape == (500, -(-9 * bits // 8))
    middle, width = cells.middles_and_widths(bytes_)
    assert (np.abs(2 * vectors - middle) <= width).all()
    centroids = np.concatenate([vectors[:12], vectors[:1]])
    distance = ((vectors[:, None, :] - centroids) ** 2).sum(axis=2)
    open_ = vafile.open_centroids(bytes_, cells, centroids)
    assert open_[distance == distance.min(axis=1)[:, None]].all()
    assert bits < 6 or open_.sum(axis=1).mean() < 5


def test_approximations_decide_most(spark):
    """On the given vectors, most are assigned without looking at them."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = vafile.clusters(table)
    assert found.where("looked_at").count() < 0.4 * found.count()


def test_query_and_sql(spark, sf):
    assert difference(QUERIES["op12_vafile"](spark, sf), ORACLE["op12_vafile"], sf) is None
