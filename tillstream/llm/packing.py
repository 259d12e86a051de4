"""Best-fit packing of token sequences with large-item matching.

A document's tokens end with an end token; documents longer than a sequence are cut, the shorter piece first. How
pieces fill sequences depends on their lengths alone, so it is planned on the counts of each length, a table of at
most `capacity` rows: pieces above a third of the capacity are matched greedily, at most two to a sequence, each with
the longest partner that fits; shorter pieces then go where they leave the least gap. The plan names ranges of ranks
within a length, and every piece finds its place by its own rank, which is counted in salted parts so that no length,
however common, meets in one task.

Cases: null and empty texts are one end token; repeated rows are packed one by one; texts are tokenized whole; an
empty table needs no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.wordids import WordIds, byte_level, flat
from tillstream.llm.words import blocks
from tillstream.session import stored

CAPACITY = 1024
END = 2
#: Bytes of text that are cut into words at once.
BLOCK = 1 << 20
PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: `doc_id`, `piece`, `start`, `length`, `ids_crc32` and, on request, the `ids` themselves."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            for begin, end in blocks(batch.column("_text"), BLOCK):
                ids, at = words.of(*flat(batch.column("_text")[begin:end]))
                ids, at = np.insert(ids, at[1:], END), at + np.arange(len(at))
                row, piece, start, length = _cut(np.diff(at), capacity)
                first = at[row] + start
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
                columns = {"doc_id": batch.column("doc_id")[begin:end].take(pa.array(row)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start),
                           "length": pa.array(length), "ids_crc32": pa.array(sums, pa.int64())}
                if with_ids:
                    columns["ids"] = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(4 * np.append(first, len(ids))), pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.record_batch(columns)
        words.forget()  # the worker process may go on with other work
        pa.default_memory_pool().release_unused()

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, {PIECE}" + ", ids binary" * with_ids)


def _cut(totals: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many ids: the text of each piece, the piece's number, its start and its length."""
    first = (totals - 1) % capacity + 1
    count = (totals - first) // capacity + 1
    row = np.repeat(np.arange(len(totals)), count)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
    return row, piece, start, np.where(piece > 0, capacity, first[row])


_known: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    """One for each worker process."""
    if path not in _known:
        _known[path] = byte_level(path)
    return _known[path]


@dataclass
class Bins:
    """`count` sequences that are filled alike: lengths of their pieces in order, and the gap that is left."""

    count: int
    gap: int
    lengths: list[int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Bins]:
    """Sequences for so many pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece has between one and `capacity` tokens")
    bins: list[Bins] = []
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        for partner in (p for p in large if p <= min(n, capacity - n)):
            pairs = left[n] // 2 if partner == n else min(left[n], left[partner])
            if pairs:
                bins.append(Bins(pairs, capacity - n - partner, [n, partner]))
                left[n] -= pairs
                left[partner] -= pairs
            if not left[n]:
                break
        if left[n]:
            bins.append(Bins(left[n], capacity - n, [n]))
            left[n] = 0
    by_gap: dict[int, list[Bins]] = {}
    for b in bins:
        by_gap.setdefault(b.gap, []).append(b)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            gap = min((g for g in by_gap if g >= n), default=0)
            if not gap:
                own = capacity // n
                full, some = divmod(left[n], own)
                new = [Bins(full, capacity, [])] * bool(full) + [Bins(1, capacity, [])] * bool(some)
                by_gap.setdefault(capacity, []).extend(new)
                bins += new
                gap = capacity
            target = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
            each = min(gap // n, left[n])  # the gap that a piece leaves is the least one, until it is too small
            filled = min(target.count, left[n] // each)
            if filled < target.count:
                rest = Bins(target.count - filled, gap, [*target.lengths])
                bins.append(rest)
                by_gap.setdefault(gap, []).append(rest)
                target.count = filled
            target.lengths += [n] * each
            target.gap -= n * each
            left[n] -= filled * each
            if target.gap:
                by_gap.setdefault(target.gap, []).append(target)
    return bins


_RANKS = 44  # bits for a rank within a length


def _segments(bins: list[Bins]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ranks, in order: length and first rank, the sequence of that rank, the offset in it."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for b in bins:
        offset = 0
        for n in b.lengths:
            rank = used.get(n, 0)
            rows.append((n << _RANKS | rank, first, offset))
            used[n] = rank + b.count
            offset += n
        first += b.count
    rows.sort()
    keys, sequence, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 3
    return keys, sequence, offset


def placed(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with `sequence_id` and `offset` added. They need `doc_id`, `piece`, `start`, `length` and `ids_crc32`."""
    counts = {int(r["length"]): r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    keys, sequence, offset = _segments(plan(counts, capacity))
    salts = max(256, sum(counts.values()) // 1_000_000)
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    before = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_salt", (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(order) - 1).join(before, ["length", "_salt"])
    own = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_before")).alias("_rank"))
    table = parts.sparkSession.sparkContext.broadcast((keys, sequence, offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequence, offset = table.value
        for batch in batches:
            own = batch.column("length").to_numpy() << _RANKS | batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, own, "right") - 1
            found = {"sequence_id": pa.array(sequence[at] + own - keys[at]), "offset": pa.array(offset[at])}
            yield pa.record_batch({name: batch.column(name) for name in batch.schema.names[:5]} | found)

    kind = parts.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, {PIECE}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its place. path: the tokenizer's file."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return placed(stored(pieces(docs, path, doc_id, text, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: `sequence_id`, `ids` (an array of `capacity` numbers at most), `doc_ids`."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    parts = stored(pieces(docs, path, doc_id, text, capacity, with_ids=True), "pieces")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    places = placed(parts.drop("ids"), capacity)
    order = Window.partitionBy(key).orderBy("sequence_id", "offset")
    same = Window.partitionBy(key).orderBy(F.lit(0))
    left = places.withColumn("_k", F.row_number().over(order))
    right = parts.withColumn("_k", F.row_number().over(same)).select(*[F.col(c).alias(f"_{c}") for c in [*key, "_k"]], "ids")
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*key, "_k"]]
    full = left.join(right, match).select("sequence_id", "offset", "doc_id", "ids")
    grouped = full.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("parts").to_pylist()
            ids = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32) for parts in rows]
            owners = pa.array([[p["doc_id"] for p in parts] for parts in rows], batch.schema.field("doc_ids").type)
            yield pa.record_batch({"sequence_id": batch.column("sequence_id"), "ids": pa.array(ids, pa.list_(pa.int32())), "doc_ids": owners})

    kind = docs.schema[doc_id].dataType.simpleString()
    own = grouped.select("sequence_id", "parts", F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
    return own.mapInArrow(run, f"sequence_id long, ids array<int>, doc_ids array<{kind}>")
