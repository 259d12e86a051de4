"""Near duplicates by one-permutation hashing with optimal densification.

A document's set are its distinct shingles of n words. One hash of each shingle gives the whole sketch: its top part
names one of `BANDS * ROWS` bins, and each bin keeps the smallest hash that falls into it. An empty bin takes the value
of a filled one, the first in an order of bins that is random for each empty bin but the same for all documents, so any
two sets still agree in each bin with a probability of their similarity. `ROWS` bins make a band, and a band's values
the key of a bucket. Within a bucket only a star of edges arises, from its smallest class to every other one, so the
candidates are never more than the entries. They are confirmed on the full sets.

Members of a bucket that are not similar to its centre may still be similar to each other. Buckets whose members the
confirmed edges leave in several components therefore go on to the exact prefix filter of `similar.open_links`, which
finds every similar pair among them without pairing what is merely common. A pair of similarity s is missed only if no
bucket has both: (1 - s^5)^32, 7 in 10^9 at 0.85. Documents with equal sets are one class and cost one entry.

Cases: null, empty and blank texts have the empty set and are linked with nothing, each its own component; texts of
fewer words than a shingle are one shingle; repeated rows are reported one by one; a null id never names a component
unless all its rows have none, and such a row is kept; texts are hashed whole, in blocks of rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.components import components
from tillstream.llm.names import unused
from tillstream.llm.similar import alike, classes_of, open_links, shingles
from tillstream.llm.words import blocks, mix
from tillstream.session import stored

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS

#: For each bin, all bins in the order in which it looks for a value when it is empty; and each bin's place there.
_HOPS = np.argsort(mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(0x5EED)).reshape(BINS, BINS), axis=1)
_PLACES = np.argsort(_HOPS, axis=1).astype(np.uint8)

#: Up to so many filled bins, an empty one looks at the places of all of them at once.
_FEW = 24


def sketches(gram: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The densified sketch of each text that has shingles, a row of `BINS` hashes; and the indices of those texts.

    gram: hashes sorted within each text; first: where each text's begin.
    """
    full = np.flatnonzero(np.diff(first))
    text = np.repeat(np.arange(len(full)), np.diff(first)[full])
    bins = (gram >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)  # in the order of the hashes
    new = np.ones(len(gram), bool)
    new[1:] = (bins[1:] != bins[:-1]) | (text[1:] != text[:-1])
    out, filled = np.zeros((len(full), BINS), np.uint64), np.zeros((len(full), BINS), bool)
    at = (text[new], bins[new].astype(np.int64))
    out[at], filled[at] = gram[new], True
    _densify(out, filled)
    return out, full


def _densify(out: np.ndarray, filled: np.ndarray) -> None:
    counts = filled.sum(axis=1)
    for n in range(1, _FEW + 1):
        rows = np.flatnonzero(counts == n)
        for some in (rows[k : k + 512] for k in range(0, len(rows), 512)):
            own = np.nonzero(filled[some])[1].reshape(len(some), n)
            nearest = np.take_along_axis(own, _PLACES[:, own].argmin(axis=2).T, axis=1)  # text by bin
            values = np.take_along_axis(out[some], nearest, axis=1)
            out[some] = np.where(filled[some], out[some], values)
    row, empty = np.nonzero(~filled & (counts > _FEW)[:, None])
    for step in range(BINS):
        if not len(row):
            break
        source = _HOPS[empty, step]
        hit = filled[row, source]
        out[row[hit], empty[hit]] = out[row[hit], source[hit]]
        row, empty = row[~hit], empty[~hit]


def bucket_keys(sketch: np.ndarray) -> np.ndarray:
    """A key per text and band."""
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sketch), BANDS)).copy()
        for k in range(ROWS):
            keys = mix(keys + sketch[:, k::ROWS])
    return keys


def _scanned(docs: DataFrame, doc_id: str, text: str, n: int, sets: bool) -> DataFrame:
    """`doc_id`, `class`, `n` and `hashes` of each document: its shingles, or else its bucket keys."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column("_text")):
                gram, first = shingles(batch.column("_text")[begin:end], n)
                ends, values = first, gram
                if not sets:
                    keys, full = bucket_keys_of(gram, first)
                    each = np.zeros(end - begin + 1, np.int64)
                    each[full + 1] = BANDS
                    ends, values = np.cumsum(each), keys.ravel()
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id")[begin:end], "class": pa.array(classes_of(gram, first).view(np.int64)), "n": pa.array(np.diff(first)),
                    "hashes": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))})

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, class long, n long, hashes array<long>")


def bucket_keys_of(gram: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket keys of each text that has shingles, and the indices of those texts."""
    sketch, full = sketches(gram, first)
    return bucket_keys(sketch), full


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, least: Fraction = Fraction(85, 100)) -> DataFrame:
    """One row per document: `doc_id`, `n_shingles`, `component_id` and `kept`.

    component_id: the smallest id that links reach, links being between sets of a Jaccard similarity of `least` or more.
    """
    own = stored(_scanned(docs, doc_id, text, n, sets=False), "sketches")
    entries = own.where("n > 0").select("class", F.explode("hashes").alias("key")).distinct()
    centres = entries.groupBy("key").agg(F.min("class").alias("centre"), F.max("class").alias("_high")).where("centre <> _high").select("key", "centre")
    shared = stored(entries.join(centres, "key"), "buckets")
    sets = stored(_scanned(docs, doc_id, text, n, sets=True).join(shared.select("class").distinct(), "class", "left_semi").select(
        "class", "hashes").dropDuplicates(["class"]), "sets")
    star = shared.where("class <> centre").select(F.col("centre").alias("a"), F.col("class").alias("b")).distinct()
    links = stored(alike(star, sets, least), "links")
    roots = components(links.union(open_links(shared.select("key", "class"), links, sets, least)), "a", "b")
    classes = own.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("_least"))
    rooted = classes.join(roots, F.col("class") == F.col("node"), "left").select("class", "_least", F.coalesce("root", "class").alias("_root"))
    named = rooted.join(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), "_root").select("class", "component_id")
    alone = own.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return own.where("n > 0").join(named, "class").select("doc_id", "n", "component_id").union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, least: Fraction = Fraction(4, 5)) -> DataFrame:
    """The documents whose id names their component, all columns as they were."""
    name = unused(docs, "_keep")
    stay = near_duplicates(docs, doc_id, text, n, least).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stay, F.col(doc_id).eqNullSafe(F.col(name)), "left_semi")
