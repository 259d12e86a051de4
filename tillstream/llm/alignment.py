"""Alignment of two tokenizers' tokens over a corpus: where both end, and which ids go together.

Both tokenizers see a text with one space before it (the piece tokenizer puts it there itself). A block of texts becomes
two Arrow tables of token occurrences: parent indices of the flattened id lists name the document, segmented cumulative
sums of token sizes give the byte where each token ends, and an Acero hash join on (document, end) links the
occurrences that end together. Ends that both have cut the tokens into groups. `Table.group_by` counts the id pairs of a
block; a task merges its blocks' counts and Spark merges the tasks', so no task sees more pairs than its own text has.

Counts come back to the documents in a second pass over their distinct pairs, which the first one wrote. The `HEAD` most
frequent pairs go to all tasks, a table of fixed size; pairs outside it are joined by Spark, exactly.

Cases: null and empty texts have no tokens, nor have texts whose tokens' joined bytes differ from the text with its space, for
either tokenizer: all their numbers are 0 and their digest is empty. Names of special tokens in a text are ordinary
text. Texts are tokenized whole, in blocks of rows; repeated rows and repeated or null ids are reported one by one; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm.wordids import WordIds, byte_level, byte_level_bytes, flat, piece_bytes, pieces
from tillstream.llm.words import blocks
from tillstream.session import stored

#: Pairs that go to all tasks.
HEAD = 1 << 18
#: Bytes of text that are aligned at once, and distinct pairs that a task holds before it hands them on.
BLOCK, HELD = 1 << 19, 1 << 18

_DOCUMENT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
SCANNED = f"row long, {_DOCUMENT}, pair long, n long"
NARROW = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


class Side:
    """A tokenizer and what its ids stand for."""

    def __init__(self, words: WordIds, tokens: list[bytes]):
        self.words = words
        self.tokens = pa.array(tokens, pa.large_binary())

    def occurrences(self, data: np.ndarray, begins: np.ndarray) -> tuple[pa.LargeListArray, np.ndarray]:
        """The ids of each text, and which texts their bytes give back."""
        ids, at = self.words.of(data, begins)
        joined, ends = flat(self.tokens.take(pa.array(ids)))
        upto = ends[at]
        same = np.diff(upto) == np.diff(begins)
        if same.all():
            wrong = np.concatenate([[0], np.cumsum(joined != data)])
            same = wrong[begins[1:]] == wrong[begins[:-1]]
        else:
            for k in np.flatnonzero(same):
                same[k] = np.array_equal(joined[upto[k] : upto[k + 1]], data[begins[k] : begins[k + 1]])
        return pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids)), same


def occurrence_table(ids: pa.LargeListArray, sizes: pa.Array, name: str) -> pa.Table:
    """One row per token: its `key` (document and end), its id and its place among all tokens."""
    doc, own = pc.list_parent_indices(ids), pc.list_flatten(ids)
    ends = pc.cumulative_sum(sizes.take(own))
    counts = pc.list_value_length(ids).to_numpy()
    first = np.cumsum(counts) - counts  # of each document, its first token
    before = np.concatenate([[0], ends.to_numpy()])[first]
    end = pc.subtract(ends, pa.array(before).take(doc))
    return pa.table({"key": pc.add(pc.shift_left(doc.cast(pa.int64()), 40), end), name: own.cast(pa.int64()), f"at_{name}": pa.array(np.arange(len(own)))})


def linked(a: pa.Table, b: pa.Table) -> pa.Table:
    """All pairs of occurrences that end together, in their order."""
    return a.join(b, "key", join_type="inner", use_threads=False).sort_by([("at_a", "ascending"), ("at_b", "ascending")])


def _written(ids: np.ndarray, marks: np.ndarray, names: pa.Array, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each with the mark after it (0 none, 1 comma, 2 bar, 3 semicolon); where each begins."""
    return flat(names.take(pa.array(marks * count + ids)))


def digests(a: pa.Table, b: pa.Table, links: pa.Table, docs: int, names: pa.Array, count: int) -> tuple[list[str], np.ndarray]:
    """Of each document, the SHA-256 of its groups as text (empty without tokens) and their number."""
    common = np.unique(links["key"].to_numpy())
    sides, groups, marks, order = [], [], [], []
    for table, name, last in ((a, "a", 2), (b, "b", 3)):
        key = table["key"].to_numpy()
        group = np.searchsorted(common, key)  # keys rise from token to token, documents included
        ending = np.ones(len(key), bool)
        ending[:-1] = group[1:] != group[:-1]
        sides.append(table[name].to_numpy())
        groups.append(group)
        marks.append(np.where(ending, last, 1))
    upto = [np.searchsorted(groups[1], groups[0], "left"), np.searchsorted(groups[0], groups[1], "right")]
    for k in range(2):
        order.append(np.arange(len(groups[k])) + upto[k])
    ids, mark, doc = (np.empty(len(order[0]) + len(order[1]), np.int64) for _ in range(3))
    for k, table in enumerate((a, b)):
        ids[order[k]], mark[order[k]], doc[order[k]] = sides[k], marks[k], table["key"].to_numpy() >> 40
    final = np.ones(len(doc), bool)
    final[:-1] = doc[1:] != doc[:-1]
    mark[final] = 0
    text, begins = _written(ids, mark, names, count)
    edges = begins[np.searchsorted(doc, np.arange(docs + 1))]
    raw = memoryview(np.ascontiguousarray(text))
    found = [hashlib.sha256(raw[x:y]).hexdigest() if y > x else "" for x, y in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
    return found, np.bincount(common >> 40, minlength=docs)


def _names(count: int) -> pa.Array:
    return pa.array([f"{k}{mark}".encode() for mark in ("", ",", "|", ";") for k in range(count)], pa.large_binary())


class Aligner:
    """Both tokenizers of a worker process."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Side(byte_level(path_a), byte_level_bytes(Tokenizer.from_file(path_a)))
        self.b = Side(pieces(path_b), piece_bytes(sentencepiece.SentencePieceProcessor(model_file=path_b)))
        self.count = max(len(self.a.tokens), len(self.b.tokens))
        self.names = _names(self.count)

    def block(self, texts: pa.Array) -> tuple[pa.Table, pa.Table, pa.Table, list[str], np.ndarray]:
        """Of some texts: occurrences of both sides, links, digests and numbers of groups."""
        full = pc.fill_null(texts.cast(pa.large_binary()), b"")
        empty = pc.equal(pc.binary_length(full), 0)
        space = pc.if_else(empty, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
        data, begins = flat(pc.binary_join_element_wise(space, full, pa.scalar(b"", pa.large_binary())))
        (ids_a, same_a), (ids_b, same_b) = (side.occurrences(data, begins) for side in (self.a, self.b))
        good = pa.array(same_a & same_b)
        none = pa.scalar([], ids_a.type)
        ids_a, ids_b = (x if good.true_count == len(x) else pa.chunked_array([pc.if_else(good, x, none)]).combine_chunks() for x in (ids_a, ids_b))
        a, b = (occurrence_table(ids, pc.binary_length(side.tokens), name) for ids, side, name in ((ids_a, self.a, "a"), (ids_b, self.b, "b")))
        links = linked(a, b)
        found, groups = digests(a, b, links, len(texts), self.names, self.count)
        return a, b, links, found, groups


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def pair_of(a: pa.Array, b: pa.Array) -> pa.Array:
    """One number for two ids, each below 2^31."""
    return pc.bit_wise_or(pc.shift_left(a, 32), b)


def _document_rows(doc_id: pa.Array, row: pa.Array, a: pa.Table, b: pa.Table, links: pa.Table, found: list[str], groups: np.ndarray) -> pa.RecordBatch:
    docs = len(row)
    doc = pc.shift_right(links["key"], 40)
    own = pa.table({"doc": doc, "pair": pair_of(links["a"], links["b"])}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
    first = np.searchsorted(own["doc"].to_numpy(), np.arange(docs + 1))
    counts = [np.bincount(t["key"].to_numpy() >> 40, minlength=docs) for t in (a, b, links)]
    n_a, n_b, n_links = (pa.array(c, pa.int64()) for c in counts)
    offsets = pa.array(first, pa.int32())
    return _batch(doc_id, row, {
        "n_a": n_a, "n_b": n_b, "n_groups": pa.array(groups, pa.int64()), "n_links": n_links, "groups_sha256": pa.array(found, pa.string()),
        "pairs": pa.ListArray.from_arrays(offsets, own["pair"].combine_chunks()), "times": pa.ListArray.from_arrays(offsets, own["count_all"].combine_chunks().cast(pa.int32()))})


_TYPES = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
          "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int32()), "pair": pa.int64(), "n": pa.int64()}


def _batch(doc_id: pa.Array, row: pa.Array, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.record_batch({"doc_id": doc_id, "row": row} | {name: columns.get(name, pa.nulls(len(row), kind)) for name, kind in _TYPES.items()})


def _count_rows(counts: pa.Table, kind: pa.DataType) -> pa.RecordBatch:
    return _batch(pa.nulls(counts.num_rows, kind), pa.nulls(counts.num_rows, pa.int64()), {"pair": counts["pair"].combine_chunks(), "n": counts["n"].combine_chunks()})


def _scanned(numbered: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents, and rows of counted pairs (without `row`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        held: pa.Table | None = None
        kind = pa.null()
        for batch in batches:
            kind = batch.column("doc_id").type
            for begin, end in blocks(batch.column("_text"), BLOCK):
                a, b, links, found, groups = aligner.block(batch.column("_text")[begin:end])
                yield _document_rows(batch.column("doc_id")[begin:end], batch.column("row")[begin:end], a, b, links, found, groups)
                own = pa.table({"pair": pair_of(links["a"], links["b"])}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
                held = own if held is None else pa.concat_tables([held, own]).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
                if held.num_rows > HELD:
                    yield _count_rows(held, kind)
                    held = None
        if held is not None:
            yield _count_rows(held, kind)
        aligner.a.words.forget()
        aligner.b.words.forget()
        pa.default_memory_pool().release_unused()

    return numbered.mapInArrow(run, f"doc_id {numbered.schema['doc_id'].dataType.simpleString()}, {SCANNED}")


def pair_counts(scanned: DataFrame) -> DataFrame:
    """`pair`, how many links hold it (`n`), and whether no pair of its second id has more (`best`)."""
    counts = scanned.where("row is null").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.col("pair").bitwiseAND(F.lit(2**32 - 1))
    counts = stored(counts.withColumn("b", most), "pairs")
    top = counts.groupBy("b").agg(F.max("n").alias("_most"))  # as many rows as the second vocabulary
    return counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def _sums(docs: DataFrame, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """The documents with sums over the pairs at hand, and their other pairs."""
    table = docs.sparkSession.sparkContext.broadcast((pairs, counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for batch in batches:
            lists = batch.column("pairs")
            own, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            at = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
            hit = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            n, good = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            n[hit], good[hit] = counts[at[hit]] * times[hit], best[at[hit]] * times[hit]
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (n, good, ~hit)]
            count, good, left = (np.diff(x[first]) for x in sums)
            offsets = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
            yield pa.record_batch({
                **{name: batch.column(name) for name in NARROW}, "count_sum": pa.array(count), "n_best": pa.array(good),
                "pairs": pa.ListArray.from_arrays(offsets, pa.array(own[~hit])), "times": pa.ListArray.from_arrays(offsets, pa.array(times[~hit].astype(np.int32)))})

    own = docs.select(*NARROW, "pairs", "times")
    kinds = ", ".join(f"{name} {own.schema[name].dataType.simpleString()}" for name in NARROW)
    return own.mapInArrow(run, f"{kinds}, count_sum long, n_best long, pairs array<long>, times array<int>")


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None, head: int = HEAD) -> DataFrame:
    """One row per document: `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    path_a: a byte-level tokenizer's file; path_b: a piece model's. head: pairs that go to all tasks.
    """
    path_a, path_b = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    numbered = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")).withColumn("row", F.monotonically_increasing_id())
    scanned = stored(_scanned(numbered, path_a, path_b), "aligned")
    documents = scanned.where("row is not null")
    counts = stored(pair_counts(scanned), "counts")
    frequent = counts.orderBy(F.desc("n"), "pair").limit(head).orderBy("pair").toArrow()
    sums = stored(_sums(documents, *(frequent[c].to_numpy() for c in ("pair", "n", "best"))), "sums")
    rest = sums.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("k"))
    added = rest.join(counts, "pair").groupBy("row").agg(F.sum(F.col("n") * F.col("k")).alias("_n"), F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("_best"))
    full = sums.drop("pairs", "times").join(added, "row", "left")
    return full.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                       (F.col("count_sum") + F.coalesce("_n", F.lit(0))).alias("count_sum"), "groups_sha256")
