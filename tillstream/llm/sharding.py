"""Shards of equal bytes by sampled splitters.

Rows are ordered by a hash of their text, then of their id, so equal texts are neighbours. A size-weighted sample of
these keys gives quantile boundaries, rows go to the ranges between them, and ranges that turn out too full are
sampled again and subdivided. Sums per range, and running sums within, give every row's place in the whole order, and
so its shard and slot. Texts are read once and not shuffled; only narrow rows are.

Equal texts stay in one shard, the one their middle falls into, so a boundary moves by half a group at most and a
shard's size by one group. Only a group of more than `tolerance` of a shard's bytes is dealt out row by row: shards
could not be as equal as that otherwise. There are at most `shards / tolerance` such groups.

Cases: a null text has no bytes and counts as equal to an empty one; every row has size one at least; repeated rows
get a slot each; an empty table gives an empty result; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.names import unused
from tillstream.session import stored

#: By how much of an even shard's bytes a shard may differ for the sake of equal texts.
TOLERANCE = 0.05
#: Rows that a range holds on average at most once there are `RANGES` of them, before overfull ones are divided; sampled keys for each.
RANGES, RANGE_ROWS, DRAWS = 1024, 1_000_000, 32


def _codes(key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """One sortable value of 16 bytes for each pair of signed numbers."""
    pair = np.empty((len(key), 2), ">u8")
    pair[:, 0], pair[:, 1] = (x.view(np.uint64) ^ np.uint64(1 << 63) for x in (key, tie))
    return pair.view("S16").ravel()


def _after(codes: np.ndarray) -> np.ndarray:
    """The next value after each."""
    pair = codes.view(">u8").reshape(-1, 2).astype(">u8")
    pair[:, 1] += np.uint64(1)
    pair[:, 0] += pair[:, 1] == 0
    return pair.view("S16").ravel()


def _ranged(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    """Add `range`: how many splitters are not above the row's key."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(*(batch.column(c).to_numpy() for c in ("key", "tie")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.searchsorted(shared.value, codes, "right"), pa.int32())], [*batch.schema.names, "range"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", range int")


def _drawn(rows: DataFrame, total: int, draws: int) -> np.ndarray:
    """Keys of about `draws` rows, sorted; a row's chance is in proportion to its size, whatever other rows of its key do."""
    chance = F.col("size") * F.lit(draws / max(1, total))
    keys = rows.where(F.rand(5) < chance).select("key", "tie").toArrow()
    return np.sort(_codes(keys["key"].to_numpy(), keys["tie"].to_numpy()))


def _quantiles(sample: np.ndarray, parts: int) -> np.ndarray:
    return sample[[len(sample) * k // parts for k in range(1, parts)]] if len(sample) else sample


def _splitters(rows: DataFrame, count: int, total: int) -> tuple[np.ndarray, list]:
    """Boundaries of the ranges, and (rows, bytes) of each range."""
    ranges = max(min(RANGES, max(16, count // 200)), count // RANGE_ROWS)
    splitters = np.unique(_quantiles(_drawn(rows, total, ranges * DRAWS), ranges))
    while True:
        ranged = _ranged(rows, splitters)
        key = F.struct("key", "tie")
        stats = {r["range"]: r for r in ranged.groupBy("range").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}
        full = {k: r["size"] for k, r in stats.items() if r["size"] > 3 * total / ranges and r["low"] != r["high"]}
        more = [splitters]
        if full:
            sample = _drawn(ranged.where(F.col("range").isin([*full])), sum(full.values()), DRAWS * len(full) * 8)
            at = np.searchsorted(splitters, sample, "right")
            for k, size in full.items():
                low = _codes(*(np.array([stats[k]["low"][c]]) for c in ("key", "tie")))
                # A frequent key is cut off on both of its sides, so that the rows beside it need no rounds of their own.
                own = _quantiles(sample[at == k], max(2, -(-size * ranges // total)))
                own = np.concatenate([own, _after(own)]) if len(own) else _after(low)
                more.append(own[own > low])
        grown = np.unique(np.concatenate(more))
        if len(grown) == len(splitters):
            empty = {"n": 0, "size": 0}
            return splitters, [(r["n"], r["size"]) for r in (stats.get(k, empty) for k in range(len(splitters) + 1))]
        splitters = grown


def shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", count: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: `doc_id`, `size`, `text_crc32`, `law` (bytes), `shard`, `slot` and `grown_shard` (null).

    tolerance: by which share of an even shard's bytes a shard may differ from it for the sake of equal texts.
    """
    spark, full = docs.sparkSession, F.coalesce(F.col(text), F.lit(""))
    narrow = stored(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(full) + 1).cast("long").alias("size"), F.crc32(full.cast("binary")).alias("text_crc32"),
        F.xxhash64(full).alias("key"), F.xxhash64(F.col(doc_id)).alias("own")), "sizes")
    rows, total = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    large = narrow.groupBy("key").agg(F.sum("size").alias("_bytes")).where(F.col("_bytes") * count > tolerance * total).select("key", F.lit(True).alias("_large"))
    tied = stored(narrow.join(F.broadcast(large), "key", "left").select(  # at most count / tolerance keys
        "doc_id", "size", "text_crc32", "key", F.when(F.col("_large"), F.col("own")).otherwise(F.lit(0)).cast("long").alias("tie")), "keys")
    splitters, stats = _splitters(tied, rows, total)
    before, n, size = [], 0, 0
    for k, (rows_in, bytes_in) in enumerate(stats):
        before.append((k, n, size))
        n, size = n + rows_in, size + bytes_in
    offsets = spark.createDataFrame(before, "range int, _rows long, _bytes long")
    within = Window.partitionBy("range").orderBy("key", "tie")
    order = Window.partitionBy("range").orderBy("key", "tie", "size", "text_crc32", "doc_id")
    same = F.sum("size").over(within.rangeBetween(Window.currentRow, Window.currentRow))
    placed = _ranged(tied, splitters).withColumns({"_end": F.sum("size").over(within), "_same": same, "_at": F.row_number().over(order) - 1})
    # rows of the same key have the same _end and _same, and so the same shard
    found = stored(placed.join(F.broadcast(offsets), "range").select(
        "doc_id", "size", "text_crc32", F.expr(f"CAST(({count} * (2 * (_bytes + _end) - _same)) DIV {2 * max(1, total)} AS INT)").alias("shard"),
        (F.col("_rows") + F.col("_at")).alias("_place")), "places")
    first = found.groupBy("shard").agg(F.min("_place").alias("_first"))
    return found.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_place") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", count: int = 8, files: int = 1) -> None:
    """Write the documents as Parquet, a folder per shard and about `files` files in each. Ids must be unique.

    The columns `shard` and `slot` come in addition, with underscores after them where the documents have such columns.
    """
    name, shard, slot = unused(docs, "_id"), unused(docs, "shard"), unused(docs, "slot")
    found = shards(docs, doc_id, text, count).select(F.col("doc_id").alias(name), F.col("shard").alias(shard), F.col("slot").alias(slot))
    part = F.pmod(F.xxhash64(slot), F.lit(files))
    full = docs.join(found, F.col(doc_id).eqNullSafe(F.col(name))).drop(name)
    full.repartition(count * files, shard, part).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
