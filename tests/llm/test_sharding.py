"""Shards of equal bytes: every row once, gapless slots, equal texts together."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tillstream.llm import sharding


def check(rows, found, count, whole=None):
    """found agrees with rows (id, text); returns bytes per shard."""
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    assert {(r.law, r.grown_shard) for r in found} <= {("bytes", None)}
    slots, sizes, groups = defaultdict(list), Counter({k: 0 for k in range(count)}), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
        groups[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(sizes.values())
    weight = Counter()
    for (_, size, crc), n in want.items():
        weight[crc, size] += n * size
    for key, own in groups.items():
        if weight[key] * count <= sharding.TOLERANCE * total:
            assert len(own) == 1
    largest = max((w for w in weight.values() if w * count <= sharding.TOLERANCE * total), default=0)
    row = max((size for _, size, _ in want), default=0)
    assert all(abs(s - total / count) <= max(largest, row) + 1 for s in sizes.values())
    return sizes


def test_even_bytes_with_a_hot_text(spark):
    rng = random.Random(2)
    rows = [(i, "h" * 50) for i in range(3000)]
    rows += [(i, "".join(rng.choices("abc é", k=rng.randint(0, 200)))) for i in range(3000, 9000)]
    rows += [(i + 10_000, rows[4000 + i][1]) for i in range(500)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, shard int")
    sizes = check(rows, sharding.shards(docs).collect(), 8)
    mean = sum(sizes.values()) / 8
    assert max(abs(s - mean) for s in sizes.values()) < 0.01 * mean


@pytest.mark.parametrize(("copies", "whole"), [(18, True), (30, False)])
def test_groups_on_both_sides_of_the_tolerance(spark, copies, whole):
    """A group just below the tolerance stays in one shard, one above it is dealt out."""
    rows = [(i, "g" * 99) for i in range(copies)] + [(1000 + i, f"{i:099d}") for i in range(2000 - copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sharding.shards(docs, count=5).collect()
    check(rows, found, 5)
    assert copies * 100 * 5 / 200_000 < sharding.TOLERANCE or not whole
    own = sharding.shards(docs, count=5, tolerance=copies * 100 * 5 / 200_000 if whole else (copies - 1) * 100 * 5 / 200_000)
    group = zlib.crc32(b"g" * 99)
    assert (len({r.shard for r in own.collect() if r.text_crc32 == group}) == 1) or not whole


def test_against_a_plain_order(spark):
    """Shard and slot of every row, worked out over one list in the order of the text's and the id's hash."""
    from pyspark.sql import functions as F

    rng = random.Random(8)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 9)))) for i in range(1500)] + [(i, "hot" * 9) for i in range(1500, 2200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    hashes = {r.doc_id: (r.key, r.own) for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.xxhash64("doc_id").alias("own")).collect()}
    size = {i: len(t.encode()) + 1 for i, t in rows}
    total, weight = sum(size.values()), Counter()
    for i, _ in rows:
        weight[hashes[i][0]] += size[i]
    tie = {i: hashes[i][1] if weight[hashes[i][0]] * 4 > sharding.TOLERANCE * total else 0 for i, _ in rows}
    order = sorted(size, key=lambda i: (hashes[i][0], tie[i], size[i], zlib.crc32(dict(rows)[i].encode()), i))
    groups, want, slots, at = defaultdict(int), {}, Counter(), 0
    for i in order:
        groups[hashes[i][0], tie[i]] += size[i]
    ends = {}
    for key in sorted(groups):
        at += groups[key]
        ends[key] = at
    for i in order:
        key = (hashes[i][0], tie[i])
        shard = 4 * (2 * ends[key] - groups[key]) // (2 * total)
        want[i] = (shard, slots[shard])
        slots[shard] += 1
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.shards(docs, count=4).collect()} == want


def test_overfull_ranges_are_divided(spark, monkeypatch):
    """Samples too small to find the boundaries: the rows of most ranges come from later rounds."""
    monkeypatch.setattr(sharding, "DRAWS", 1)
    rows = [(i, "same") for i in range(2000)] + [(i, f"text {i}") for i in range(2000, 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = check(rows, sharding.shards(docs, count=4).collect(), 4)
    mean = sum(sizes.values()) / 4
    assert max(abs(s - mean) for s in sizes.values()) < 0.03 * mean


def test_a_frequent_text_is_cut_off_at_once(spark, monkeypatch):
    """A text that overfills a range without being dealt out: rounds do not follow the rows that share its range."""
    rounds, drawn = [], sharding._drawn
    monkeypatch.setattr(sharding, "_drawn", lambda *args: rounds.append(1) or drawn(*args))
    rows = [(i, "same text " * 4) for i in range(600)] + [(i, f"text {i:035d}") for i in range(600, 12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shards(docs, tolerance=1.0).collect()
    assert Counter(r.doc_id for r in found) == Counter(range(12_000)) and len(rounds) <= 4
    assert len({r.shard for r in found if r.doc_id < 600}) == 1
    codes = [sharding._codes(*(sharding.np.array([x]) for x in pair)) for pair in ((3, 2**63 - 1), (4, -(2**63)), (4, 1 - 2**63))]
    assert sharding._after(codes[0]) == codes[1] > codes[0] and sharding._after(codes[1]) == codes[2]


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "x"), (None, None), (5, "y" * 100_000), (6, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, sharding.shards(docs).collect(), 8)
    assert sharding.shards(docs.where("false")).count() == 0


def test_written_shards(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, i, "own", "_") for i, t in rows], "doc_id long, text string, slot int, shard string, _id string")
    sharding.write_shards(docs, f"{tmp_path}/out", count=3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert Counter((r.doc_id, r.text, r.slot, r["shard"], r["_id"]) for r in back.collect()) == Counter((i, t, i, "own", "_") for i, t in rows)
    assert {r.shard_ for r in back.collect()} == {0, 1, 2}
    assert sorted(p.name for p in (tmp_path / "out").glob("shard_=*")) == ["shard_=0", "shard_=1", "shard_=2"]


@pytest.mark.parametrize("count", [1, 5])
def test_other_counts(spark, sf, count):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, sharding.shards(docs, count=count).collect(), count)
