"""Benchmark decontamination: rare n-gram seeds bring passages to test items, Smith-Waterman alignment scores them.

Words are runs of letters and digits, lower-cased (A-Z). Seeds are an item's n-grams. Of any `window` in a row the one
that is rarest in the corpus is a rare seed, and one hit of it is enough for an alignment; the others need a second hit
near by, as single frequent n-grams are chance. So whatever keeps `n + window - 1` words in a row, or two n-grams, is
aligned, and no seed is left out for being frequent. A filter of fixed size, made of all n-grams of the benchmark,
tells the one scan of the corpus which places to hand on; the exact joins that follow see only those.

An alignment gains 2 for an equal word and loses 1 for a changed, missing or added one; its score is the share of the
most that the item can reach. Copies, also edited ones, score 0.6 or more unless over a quarter of the words changed.

Items of equal words are searched once, under a number of their own; all their ids come back at the end, null ids too.

Cases: null and empty texts contain nothing; items with fewer than n words prove nothing and are left out; items of one
id but different words are searched on their own and reported once, with the best score; rows that repeat an id are searched one by one and reported once for
each item, with the best score; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.names import unused
from tillstream.llm.words import MARKS, Words, blocks, grams
from tillstream.session import stored

#: Bits of the filter, as a power of two: 2 MB, whatever the benchmark's size.
FILTER = 24


def _items(bench: DataFrame, item_id: str, text: str, n: int) -> tuple[DataFrame, DataFrame]:
    """`item` (a number) and `words` (hashes) of each different item of n words or more; and `item` and `item_id` of all of them."""
    own = bench.select(F.col(item_id).alias("item_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("_text"), MARKS)
            lists = pa.ListArray.from_arrays(pa.array(words.first, pa.int32()), pa.array(words.hashes().view(np.int64)))
            yield pa.record_batch({"item_id": batch.column("item_id"), "words": lists})

    kind = own.schema["item_id"].dataType.simpleString()
    found = stored(own.mapInArrow(run, f"item_id {kind}, words array<long>").where(F.size("words") >= n), "bench")
    items = stored(found.select("words").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    return items, stored(found.join(items, "words").select("item", "item_id").distinct(), "ids")


def _item_grams(items: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, place, gram = [], [], []
            for k, words in enumerate(batch.column("words")):
                own = grams(words.values.to_numpy().view(np.uint64), n)
                item.append(np.full(len(own), k))
                place.append(np.arange(len(own)))
                gram.append(own.view(np.int64))
            at = pa.array(np.concatenate(item)) if item else pa.array([], pa.int64())
            yield pa.record_batch({"item": batch.column("item").take(at), "place": pa.array(np.concatenate(place) if place else [], pa.int32()),
                                   "gram": pa.array(np.concatenate(gram) if gram else [], pa.int64())})

    return items.select("item", "words").mapInArrow(run, "item long, place int, gram long")


def _filter(item_grams: DataFrame) -> np.ndarray:
    """The filter: one bit for the first bits of every n-gram of the benchmark."""
    top = F.shiftrightunsigned("gram", 64 - FILTER)
    rows = item_grams.groupBy(F.shiftright(top, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(gram, {64 - FILTER}) & 63L AS INT))")).alias("bits")).toArrow()
    words = np.zeros(1 << FILTER - 6, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words


def _places(docs: DataFrame, doc_id: str, text: str, n: int, margin: int, filter_words: np.ndarray) -> DataFrame:
    """Stretches of documents with n-grams that the filter lets pass, and `margin` words around them."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(filter_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin, end in blocks(batch.column("_text")):
                words = Words(batch.column("_text")[begin:end], MARKS)
                hashes, text = words.hashes(), words.text_of()
                found = grams(hashes, n)
                top = found >> np.uint64(64 - FILTER)
                hit = np.flatnonzero(bits[top >> np.uint64(6)] >> (top & np.uint64(63)) & np.uint64(1))
                hit = hit[text[hit] == text[hit + n - 1]]
                if not len(hit):
                    continue
                new = np.ones(len(hit), bool)
                new[1:] = (text[hit[1:]] != text[hit[:-1]]) | (np.diff(hit) > n + 2 * margin)
                first = np.flatnonzero(new)
                last = np.concatenate([first[1:], [len(hit)]]) - 1
                of = text[hit[first]]
                low = np.maximum(hit[first] - margin, words.first[of])
                high = np.minimum(hit[last] + n + margin, words.first[of + 1])
                size = high - low
                inside = np.arange(size.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(size)])[:-1], size)
                ends = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                cuts = pa.array(np.concatenate([first, [len(hit)]]), pa.int32())
                at = hit - np.repeat(low, np.diff(np.concatenate([first, [len(hit)]])))
                hits = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(found[hit].view(np.int64))], ["at", "gram"])
                yield pa.record_batch({
                    "stretch": pa.array(np.arange(row, row + len(first))), "doc_id": batch.column("doc_id")[begin:end].take(pa.array(of)),
                    "begin": pa.array(low - words.first[of]), "words": pa.ListArray.from_arrays(ends, pa.array(hashes[inside].view(np.int64))),
                    "hits": pa.ListArray.from_arrays(cuts, hits)})
                row += len(first)

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"stretch long, doc_id {kind}, begin long, words array<long>, hits array<struct<at:int,gram:long>>")


def _best(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Highest local alignment score, and the last item and passage word of that alignment."""
    place = np.arange(len(passage))
    above, best = np.zeros(len(passage), np.int64), (0, 0, 0)
    for i, word in enumerate(item):
        step = np.where(passage == word, 2, -1)
        step[1:] += above[:-1]
        row = np.maximum(np.maximum(step, above - 1), 0)
        row = np.maximum.accumulate(row + place) - place
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j)
        above = row
    return best


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment and the passage words it covers: first, and one after the last."""
    score, i, j = _best(item, passage)
    if not score:
        return 0, 0, 0
    _, _, back = _best(item[: i + 1][::-1], passage[: j + 1][::-1])
    return score, j - back, j + 1


def leaks(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", n: int = 3, window: int = 3, least: float = 0.6) -> DataFrame:
    """One row per document and item found in it: `doc_id`, `item_id`, `score`, `first_word`, `end_word`.

    The last two are the aligned words' places in the document.
    """
    items, ids = _items(bench, item_id, item_text, n)
    known = stored(_item_grams(items, n), "grams")
    margin = items.agg(F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0] * 5 // 4
    places = stored(_places(docs, doc_id, text, n, margin, _filter(known)), "stretches")
    hits = places.select("stretch", F.explode("hits").alias("hit")).select("stretch", "hit.at", "hit.gram")
    frequency = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ranked = known.join(frequency, "gram").withColumn("rank", F.struct("n", "gram", "place"))
    by_place = Window.partitionBy("item").orderBy("place")
    won = F.collect_list("least.place").over(by_place.rangeBetween(1 - window, 0))
    seeds = ranked.withColumn("least", F.min("rank").over(by_place.rangeBetween(0, window - 1))).select(
        "item", "gram", F.array_contains(won, F.col("place")).alias("rare"))
    pairs = hits.join(seeds, "gram").groupBy("stretch", "item").agg(
        F.sort_array(F.collect_set("at")).alias("at"), F.max("rare").alias("rare")).where("rare OR size(at) > 1").drop("rare")
    both = pairs.join(places.select("stretch", "doc_id", "begin", "words"), "stretch").join(
        items.select("item", F.col("words").alias("item_words")), "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                item, words = (batch.column(c)[k].values.to_numpy() for c in ("item_words", "words"))
                reach = len(item) * 5 // 4
                at, begin = batch.column("at")[k].values.to_numpy(), batch.column("begin")[k].as_py()
                cuts = np.flatnonzero(np.diff(at) > n + 2 * reach) + 1
                for group in np.split(at, cuts):
                    low = max(0, int(group[0]) - reach)
                    score, a, b = align(item, words[low : int(group[-1]) + n + reach])
                    out.append((k, score / (2 * len(item)), begin + low + a, begin + low + b))
            rows, *columns = zip(*out, strict=True) if out else [()] * 4
            at = pa.array(rows, pa.int64())
            yield pa.record_batch({"doc_id": batch.column("doc_id").take(at), "item": batch.column("item").take(at), "score": pa.array(columns[0], pa.float64()),
                                   "first_word": pa.array(columns[1], pa.int64()), "end_word": pa.array(columns[2], pa.int64())})

    kind = both.schema["doc_id"].dataType.simpleString()
    found = both.select("doc_id", "item", "begin", "words", "at", "item_words").mapInArrow(run, f"doc_id {kind}, item long, score double, first_word long, end_word long")
    top = F.max(F.struct("score", (-F.col("first_word")).alias("first"), "end_word")).alias("best")
    by_item = found.where(F.col("score") >= least).groupBy("doc_id", "item").agg(top)
    best = by_item.join(ids, "item").groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "item_id", "best.score", (-F.col("best.first")).alias("first_word"), "best.end_word")


def without_leaks(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that contain no item, all columns as they were."""
    name = unused(docs, "_leak")
    found = leaks(docs, bench, doc_id, text, **options).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, F.col(doc_id).eqNullSafe(F.col(name)), "left_anti")
