"""Exact and near duplicates against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.llm import exact_dedup, simhash
from tillstream.llm.components import components
from tillstream.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, score double, kept string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Component of each position, by comparing all."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, white space, ties, repeated rows, a very long text, columns named as the results are."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Ab c"), (5, "aB C"), (6, "ÉA b"), (7, "éa b"), (7, "éa b"), (None, "solo"), (None, "ab c"),
            (8, "word " * 40_000), (9, "WORD " * 40_000), (10, "x"), (11, "one two"), (12, "ONE  two")]
    return rows, spark.createDataFrame([(i, t, 0.5, "z") for i, t in rows], SCHEMA)


def test_exact_groups(odd):
    rows, docs = odd
    found = [(r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(docs).collect()]
    want = []
    for i, t in rows:
        same = [k for k, u in rows if lower(u) == lower(t)]
        keep = max((k for k in same if k is not None), default=None)
        want.append((i is None, i or 0, keep, len(same), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_without_copies(odd):
    rows, docs = odd
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 9, 10, 11, 12]


def test_without_copies_keeps_all_columns(spark):
    """Columns called like those of the search, and ids that repeat with other texts."""
    rows = [(1, "a", "p", 1), (1, "A", "q", 2), (1, "b", "r", 3), (2, "b", "s", 4), (2, "c", "t", 5), (3, None, "u", 6), (None, "", "v", 7), (None, "d", "w", 8), (4, "e", "x", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _keep string, _digest_own int")
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    found = sorted(r._digest_own for r in kept.collect())
    assert found in ([1, 4, 5, 6, 8, 9], [2, 4, 5, 6, 8, 9])


def test_prefix_hash_does_not_join_longer_texts(spark):
    docs = spark.createDataFrame([(1, "a" * 300 + "x"), (2, "a" * 300 + "y"), (3, "a" * 300 + "x")], "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in exact_dedup.exact_groups(docs).collect()) == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]


def test_empty_tables(spark, odd):
    empty = odd[1].where("false")
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.without_copies(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_fingerprints_and_components(spark, sf, odd):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(odd[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_print(t) for _, t in rows]
    root = plain_components(prints)
    least = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    for (i, _), p, r in zip(rows, prints, root, strict=True):
        assert found[i].fingerprint % 2**64 == p
        assert found[i].component_id == least[r]


def test_null_ids_and_repeated_rows(odd):
    rows, docs = odd
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r.component_id for r in found if r.doc_id in (4, 5)} == {4}


def near(base, bits, rng):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("direct", [20_000, 8, 1])
def test_links_against_all_pairs(spark, monkeypatch, direct):
    """Also with entries so small that the finer index and the look-up of neighbours take over."""
    monkeypatch.setattr(simhash, "DIRECT", direct)
    rng = random.Random(direct)
    prints = [0, 1, 2**63, 2**64 - 1]
    for _ in range(30):
        base = rng.getrandbits(64)
        prints += [near(base, rng.randint(0, 5), rng) for _ in range(12)]
    prints = sorted(set(prints))
    choices, keys, values = [], [], []
    for k, c in enumerate(simhash.CHOICES):
        mask = sum(0xFF << 8 * p for p in c)
        for key, p in sorted((p & mask, p) for p in prints):
            choices.append(k), keys.append(key), values.append(p)
    a, b = simhash.entry_links(np.array(choices, np.uint8), np.array(keys, np.uint64), np.array(values, np.uint64))
    assert all((int(x) ^ int(y)).bit_count() <= 3 for x, y in zip(a, b, strict=True))
    at = {p: i for i, p in enumerate(prints)}
    kept = simhash.forest(np.array([at[int(x)] for x in a]), np.array([at[int(x)] for x in b]), len(prints))
    root = plain_components(prints)
    assert len(kept) == len(prints) - len(set(root))


def test_links_of_a_table(spark):
    rng = random.Random(1)
    base = rng.getrandbits(63)
    prints = sorted({near(base, k % 4, rng) & (2**63 - 1) for k in range(200)})
    table = spark.createDataFrame([(p,) for p in prints], "p long")
    found = {r.node: r.root for r in components(simhash.links(table, "p"), "a", "b").collect()}
    root = plain_components(prints)
    want = {}
    for p, r in zip(prints, root, strict=True):
        want.setdefault(r, []).append(p)
    assert found == {p: min(g) for g in want.values() if len(g) > 1 for p in g}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert found == {i: 100 for i in range(100, 141)} | {7: 7} | {k: 7 for k in range(200, 260)}


def test_query_columns(spark, sf):
    found = QUERIES["op9_simhash"](spark, sf)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert found.where(~F.col("fingerprint").rlike("^[0-9a-f]{16}$")).count() == 0
    assert QUERIES["op3_exact_dedup"](spark, sf).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
