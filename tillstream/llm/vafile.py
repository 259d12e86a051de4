"""Centroid clustering over a vector approximation file.

Vectors are integers per component. The approximation file holds, for each vector, the cell of every component in a few
bits; cells are cut at quantiles of all vectors. Two lookup tables turn a cell into the middle and the width of what it
covers. From these a vector's approximation gives, for each centroid, an interval of its squared distance less that to the
centroid which is nearest to the middle (the difference is linear in the vector, so the interval is far narrower than two
distances on their own). Centroids whose interval lies above zero cannot be nearest. If no other is left, the vector is
assigned from its approximation alone. Where intervals overlap, the full vector is fetched, by its row number, and compared
with the centroids that are left.

Sums are kept from round to round: after the first one, only vectors that change their cluster move them, and only these
and the undecided ones are fetched. The first round, which needs every vector for its sums, and the last, which reports
every distance, read bytes and vectors side by side. What leaves a task is one row per vector and one per cluster; the driver
sees the centroids, their sums (`k` rows) and the cells' bounds (`dims` rows) alone. All arithmetic is in integers, so
the result depends on no order of rows, tasks or retries. Each round is a table in the shared folder.

Cases: vectors with another number of components, a null or a non-finite one are left out, as are null vectors; a
component beyond `LARGEST` counts as that; repeated rows are clustered one by one; fewer than `k` vectors with an id give
as many centroids; vectors without an id are assigned but start no centroid; equal hashes are ordered by their vectors; an
empty table, or one without any id, gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.session import stored

#: Bound of a component after scaling, so that squared distances are exact in 64 bits, floating or not.
LARGEST = 1 << 22
BLOCK = 4096


@dataclass(frozen=True)
class Cells:
    """Integer bounds of the cells: `low[d, c]` to `high[d, c]`, both included. An approximation has `bits` bits a component."""

    low: np.ndarray
    high: np.ndarray
    bits: int

    def approximate(self, vectors: np.ndarray) -> np.ndarray:
        """The cells of each vector, packed: a row of bytes each."""
        cells = np.empty(vectors.shape, np.uint8)
        for d in range(vectors.shape[1]):
            cells[:, d] = np.searchsorted(self.low[d, 1:], vectors[:, d], "right")
        bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return np.packbits(bits.reshape(len(vectors), vectors.shape[1] * self.bits), axis=1)

    def middles_and_widths(self, approximations: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each component, twice the middle and the width of its cell, looked up."""
        dims, count = self.low.shape
        bits = np.unpackbits(approximations, axis=1, count=dims * self.bits).reshape(len(approximations), dims, self.bits)
        full = np.zeros((len(approximations), dims, 8), np.uint8)
        full[:, :, 8 - self.bits :] = bits
        place = np.packbits(full, axis=2)[:, :, 0].astype(np.int64) + count * np.arange(dims)
        return (self.low + self.high).ravel().astype(float)[place], (self.high - self.low).ravel().astype(float)[place]


def open_centroids(approximations: np.ndarray, cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be nearest, by vector and centroid: all nearest ones, and those whose interval overlaps theirs."""
    middles, widths = cells.middles_and_widths(approximations)
    points = centroids.astype(float)
    middle = (points**2).sum(axis=1) - middles @ points.T
    likely = middle.argmin(axis=1)
    out = np.zeros(middle.shape, bool)
    for k in np.unique(likely):
        rows = np.flatnonzero(likely == k)
        spread = widths[rows] @ np.abs(points - points[k]).T
        out[rows] = middle[rows] - middle[rows, k : k + 1] - spread <= 0
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of each vector's open centroids, the first one of equals, and its squared distance."""
    best, distance = np.full(len(vectors), -1, np.int32), np.full(len(vectors), np.iinfo(np.int64).max)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, k])
        own = ((vectors[rows] - centroid) ** 2).sum(axis=1)
        less = own < distance[rows]
        best[rows[less]], distance[rows[less]] = k, own[less]
    return best, distance


def usable(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: int) -> DataFrame:
    """`vec_id` and the scaled components `v` of the vectors that have `dims` finite ones."""
    own = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    good = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bounded = own.where((F.size("x") == dims) & F.coalesce(good, F.lit(False)))
    return bounded.select("vec_id", F.transform(
        "x", lambda x: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x * scale))).cast("int")).alias("v"))


def _cells(kept: DataFrame, dims: int, bits: int) -> Cells:
    """Cells between quantiles of each component over all vectors; the outer ones end at its least and greatest value."""
    count = 1 << bits
    rows = kept.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), F.percentile_approx("x", [k / count for k in range(1, count)], 20 * count).alias("cuts")).collect()
    low, high = np.zeros((dims, count), np.int64), np.zeros((dims, count), np.int64)
    for r in rows:
        low[r["d"]] = [r["low"], *r["cuts"]]
        high[r["d"]] = np.maximum([*(c - 1 for c in r["cuts"]), r["high"]], low[r["d"]])
    return Cells(low, high, bits)


def approximated(kept: DataFrame, cells: Cells) -> DataFrame:
    """The vectors with a row number of their own and their approximation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_ = cells.approximate(_matrix(batch.column("v"), cells))
            own = pa.FixedSizeBinaryArray.from_buffers(pa.binary(bytes_.shape[1]), len(bytes_), [None, pa.py_buffer(np.ascontiguousarray(bytes_))])
            yield pa.record_batch({name: batch.column(name) for name in ("row", "vec_id", "v")} | {"cells": own.cast(pa.binary())})

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, f"row long, vec_id {kind}, v array<int>, cells binary")


def _matrix(column: pa.Array, cells: Cells) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), len(cells.low))


def _bytes(column: pa.Array, cells: Cells) -> np.ndarray:
    """The approximations of a batch, a row of bytes each."""
    plain = column.cast(pa.binary()).cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    return np.frombuffer(plain.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), -(-len(cells.low) * cells.bits // 8))


class _Sums:
    """Component sums and counts per cluster."""

    def __init__(self, k: int, dims: int):
        self.sums, self.counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)

    def add(self, clusters: np.ndarray, vectors: np.ndarray, sign: int = 1) -> None:
        order = np.argsort(clusters, kind="stable")
        own, first = np.unique(clusters[order], return_index=True)
        if len(own):
            self.sums[own] += sign * np.add.reduceat(vectors[order], first, axis=0)
            self.counts[own] += sign * np.diff([*first, len(order)])

    def batch(self) -> pa.RecordBatch:
        own = np.flatnonzero(self.counts.astype(bool) | self.sums.any(axis=1))
        return _rows(pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.binary()), own,
                     pa.array([[int(self.counts[k]), *self.sums[k].tolist()] for k in own], pa.list_(pa.int64())))


MOVED = "row long, cells binary, cluster int, sums array<long>"


def _rows(row: pa.Array, cells: pa.Array, cluster: np.ndarray, sums: pa.Array | None = None) -> pa.RecordBatch:
    sums = pa.nulls(len(row), pa.list_(pa.int64())) if sums is None else sums
    return pa.record_batch({"row": row, "cells": cells, "cluster": pa.array(np.asarray(cluster, np.int32)), "sums": sums})


def _first_round(store: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """Every vector's cluster, and the sums that each task saw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(*centroids.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = _matrix(part.column("v"), cells)
                cluster, _ = _assigned(_bytes(part.column("cells"), cells), vectors, cells, centroids)
                sums.add(cluster, vectors)
                yield _rows(part.column("row"), part.column("cells"), cluster)
        yield sums.batch()

    return store.select("row", "cells", "v").mapInArrow(run, MOVED)


def _assigned(approximations: np.ndarray, vectors: np.ndarray, cells: Cells, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster, and which vectors were looked at for it."""
    open_ = open_centroids(approximations, cells, centroids)
    cluster, several = open_.argmax(axis=1).astype(np.int32), open_.sum(axis=1) > 1
    cluster[several] = nearest(vectors[several], centroids, open_[several])[0]
    return cluster, several


def _decided(state: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """`row`, `cells`, the old cluster, the new one where the bytes decide it, and else the centroids that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                open_ = open_centroids(_bytes(part.column("cells"), cells), cells, centroids)
                several = open_.sum(axis=1) > 1
                left = np.packbits(open_, axis=1)
                yield pa.record_batch({
                    "row": part.column("row"), "cells": part.column("cells"), "old": part.column("cluster"),
                    "cluster": pa.array(open_.argmax(axis=1).astype(np.int32), mask=several),
                    "left": pa.array([x.tobytes() if s else None for x, s in zip(left, several.tolist(), strict=True)], pa.binary())})

    return state.select("row", "cells", "cluster").mapInArrow(run, "row long, cells binary, old int, cluster int, left binary")


def _fetched(wanted: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """The clusters of vectors that are undecided or have moved, and how these change the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(*centroids.shape)
        for batch in batches:
            vectors, old = _matrix(batch.column("v"), cells), batch.column("old").to_numpy(zero_copy_only=False)
            cluster = batch.column("cluster").fill_null(-1).to_numpy(zero_copy_only=False).copy()
            several = np.flatnonzero(cluster < 0)
            if len(several):
                left = np.frombuffer(b"".join(batch.column("left").take(pa.array(several)).to_pylist()), np.uint8).reshape(len(several), -1)
                open_ = np.unpackbits(left, axis=1, count=len(centroids)).astype(bool)
                cluster[several] = nearest(vectors[several], centroids, open_)[0]
            moved = np.flatnonzero(cluster != old)
            sums.add(cluster[moved], vectors[moved])
            sums.add(old[moved], vectors[moved], -1)
            yield _rows(batch.column("row"), batch.column("cells"), cluster)
        yield sums.batch()

    return wanted.select("row", "cells", "old", "cluster", "left", "v").mapInArrow(run, MOVED)


def _added(moved: DataFrame, sums: np.ndarray) -> np.ndarray:
    """The sums (count, then components, a row per cluster) after a round; at most one row per cluster reaches the driver."""
    parts = moved.where("row is null").select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("x"))
    out = sums.copy()
    for r in parts.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("sums")).collect():
        out[r["cluster"]] += [s["x"] for s in r["sums"]]
    return out


def _means(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Floor of sum by count; a cluster without vectors keeps its centroid."""
    counts = sums[:, :1]
    return np.where(counts > 0, np.floor_divide(sums[:, 1:], np.maximum(counts, 1)), centroids)


def _start(kept: DataFrame, k: int, seed: str, dims: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order."""
    named = kept.where("vec_id is not null").withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["v"] for r in named.orderBy("_hash", "v").limit(k).select("v").collect()], np.int64).reshape(-1, dims)


def clusters(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = 64, k: int = 40,
             rounds: int = 5, bits: int = 6, scale: int = 256, seed: str = "2") -> DataFrame:
    """One row per vector: `vec_id`, `cluster`, `distance`, `cluster_inertia`, `inertia`, `centroid_sha256`, `looked_at`.

    bits: of a cell, eight at most. looked_at: whether the last round needed the vector itself to choose its cluster.
    """
    if not 1 <= bits <= 8:
        raise ValueError("a cell has one to eight bits")
    kept = usable(vectors, vec_id, embedding, dims, scale)
    centroids = _start(kept, k, seed, dims)
    if not len(centroids):
        kind = vectors.schema[vec_id].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, looked_at boolean")
    cells = _cells(kept, dims, bits)
    store = stored(approximated(kept, cells), "vectors")
    sums = np.zeros((len(centroids), dims + 1), np.int64)
    state = None
    for _ in range(rounds):
        if state is None:
            moved = stored(_first_round(store, cells, centroids), "round")
            state = moved.where("row is not null")
        else:
            decided = stored(_decided(state, cells, centroids), "decided")
            stays = F.col("cluster").isNotNull() & (F.col("cluster") == F.col("old"))
            moved = stored(_fetched(decided.where(~stays).join(store.select("row", "v"), "row"), cells, centroids), "round")
            state = decided.where(stays).select("row", "cells", "cluster").union(moved.where("row is not null").select("row", "cells", "cluster"))
        sums = _added(moved, sums)
        centroids = _means(centroids, sums)
    return _reported(stored(_last_round(store, cells, centroids), "clusters"), centroids)


def _last_round(store: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """Every vector's cluster and its distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = _matrix(part.column("v"), cells)
                cluster, several = _assigned(_bytes(part.column("cells"), cells), vectors, cells, centroids)
                distance = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
                yield pa.record_batch({"vec_id": part.column("vec_id"), "cluster": pa.array(cluster), "distance": pa.array(distance), "looked_at": pa.array(several)})

    kind = store.schema["vec_id"].dataType.simpleString()
    return store.select("vec_id", "cells", "v").mapInArrow(run, f"vec_id {kind}, cluster int, distance long, looked_at boolean")


def _reported(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows at most
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(k, s, sum(sums.values()), names[k]) for k, s in sums.items()]
    own = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(own), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "looked_at")
