"""Toxicity: FTRL-proximal logistic regression over hashed words, word stems, word pairs and skip-grams.

Every coordinate has its own learning rate, which falls with the gradients it has seen, and an L1 threshold below
which its weight is zero. What remains is a few thousand weights, a table that any task can hold.

Cases: a null or empty text has no feature and gets the score of the bias alone; repeated rows and ids are scored one
by one; labels that are null, or whose document is missing, teach nothing; without any label every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.words import MARKS, Words, blocks, mix

BITS = 22
#: Bytes of a word that count as its stem, for words that training has not met.
STEMS = (4, 6)


@dataclass
class Model:
    """Weights that are not zero, by coordinate in order, and the bias."""

    bias: float = 0.0
    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float64))


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature, the texts and the coordinates of all its occurrences."""
    hashes, *stems = words.hashes(*STEMS)
    text = words.text_of()
    down = np.uint64(64 - BITS)
    yield text, (mix(hashes) >> down).astype(np.int32)
    for k, stem in enumerate(stems):
        yield text, (mix(stem ^ np.uint64(0xA5 + k)) >> down).astype(np.int32)
    for gap in (1, 2):  # neighbours, and words with one between them
        same = text[:-gap] == text[gap:]
        with np.errstate(over="ignore"):
            pair = mix(hashes[:-gap] * np.uint64(2 * gap + 1) + hashes[gap:])
        yield text[:-gap][same], (pair[same] >> down).astype(np.int32)


class Ftrl:
    """The sums of one online run. bias: log odds of the label, which a text without known features keeps."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float, bias: float):
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, bias
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weight(self, z: np.ndarray, root: np.ndarray) -> np.ndarray:
        excess = np.maximum(np.abs(z) - self.l1, 0.0)
        return -np.sign(z) * excess / ((self.beta + root) / self.alpha + self.l2)

    def learn(self, places: np.ndarray, label: int) -> None:
        z, n = self.z[places], self.n[places]
        root = np.sqrt(n)
        w = self.weight(z, root)
        slope = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias, -35, 35))) - label
        grown = n + slope * slope
        self.z[places] = z + slope - (np.sqrt(grown) - root) / self.alpha * w
        self.n[places] = grown


def train(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", most: int = 40_000,
          alpha: float = 0.3, beta: float = 1.0, l1: float = 3.0, l2: float = 1e-3) -> Model:
    """Learn from a sample of about `most` labelled documents at most, chosen by a hash of the id.

    The bound makes it an online run of one task, whatever the size of the corpus, and the sampled ids a small table.
    """
    known = labels.where(F.col(label).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"), F.xxhash64(F.col(doc_id)).alias("_order"))
    known = known.join(docs.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
    count, ones = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("_label") > 0).cast("int")), F.lit(0))).first()
    share, bias = min(1.0, most / max(1, count)), float(np.log((ones + 0.5) / (count - ones + 0.5)))
    sample = known.where(F.shiftrightunsigned("_order", 32) < int(share * 2**32))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    ordered = rows.select("_order", "_label", "_text").repartition(1).sortWithinPartitions("_order", "_label", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ftrl = Ftrl(alpha, beta, l1, l2, bias)
        for batch in batches:
            texts, marks = batch.column("_text"), batch.column("_label").to_numpy(zero_copy_only=False)
            for begin, end in blocks(texts):
                kinds = [*features(Words(texts[begin:end], MARKS))]
                keys = np.unique(np.concatenate([t.astype(np.int64) << BITS | p for t, p in kinds]))
                cuts = np.searchsorted(keys, np.arange(end - begin + 1, dtype=np.int64) << BITS)
                places = (keys & ((1 << BITS) - 1)).astype(np.int32)
                for i in range(end - begin):
                    ftrl.learn(places[cuts[i] : cuts[i + 1]], int(marks[begin + i] > 0))
        kept = np.flatnonzero(np.abs(ftrl.z) > l1)
        yield pa.record_batch({"place": pa.array(kept, pa.int32()), "weight": pa.array(ftrl.weight(ftrl.z[kept], np.sqrt(ftrl.n[kept])), pa.float64())})

    model = ordered.mapInArrow(run, "place int, weight double").toPandas().sort_values("place")
    return Model(bias, model["place"].to_numpy(np.int32), model["weight"].to_numpy(np.float64))


def scores(texts: pa.Array, dense: np.ndarray, bias: float) -> np.ndarray:
    """The probability of label 1 for each text. dense: a weight for each coordinate."""
    out = np.zeros(len(texts))
    for begin, end in blocks(texts):
        hits = []
        for text, places in features(Words(texts[begin:end], MARKS)):
            hit = np.flatnonzero(dense[places])
            hits.append(text[hit].astype(np.int64) << BITS | places[hit])
        keys = np.unique(np.concatenate(hits))
        out[begin:end] = np.bincount(keys >> BITS, dense[keys & ((1 << BITS) - 1)], end - begin)
    return 1 / (1 + np.exp(-np.clip(out + bias, -35, 35)))


def _scored(docs: DataFrame, model: Model, text: str, schema: str, rows) -> DataFrame:
    """Apply `rows(batch, scores)` to every batch; the weights go out once per executor."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[own.places] = own.weights
        for batch in batches:
            yield rows(batch, scores(batch.column(text), dense, own.bias))

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", limit: float = 0.3) -> DataFrame:
    """One row per document: `doc_id`, `score` and `predicted` (1 where the score reaches the limit)."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def rows(batch: pa.RecordBatch, found: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(found), "predicted": pa.array((found >= limit).astype(np.int32))})

    return _scored(own, model, "_text", f"doc_id {own.schema['doc_id'].dataType.simpleString()}, score double, predicted int", rows)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.3) -> DataFrame:
    """The documents whose score stays below the limit, all columns as they were; no shuffle."""
    return _scored(docs, model, text, docs.schema, lambda batch, found: batch.filter(pa.array(found < limit)))


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """True for ids whose CRC-32 (of the id as text) leaves that remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))
