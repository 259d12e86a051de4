"""Near copies: texts whose sets of word shingles have a Jaccard similarity of `least` or more.

Candidates come from min-hashes: a text has `BANDS` keys, each of `ROWS` minima of its shingles' hashes, so a pair of
similarity 0.8 shares no key with probability (1 - 0.8^4)^32, about 5 in 10^8. Candidates are compared exactly, on the
full sets. Texts with equal sets are one entry. Of the texts under one key, each is first compared with two of them, so
a large group of near copies costs comparisons linear in its size. Keys that this leaves with several components go on
to an exact prefix filter (`rare_pairs`): two similar sets share one of their rarest shingles, so what many texts have in
common never makes a pair.

`one_of_each` takes these links together with those of SimHash fingerprints (`simhash.py`), which see how often a shingle
occurs: texts that either kind of link connects are of one component.

Cases: texts of fewer words than a shingle are one shingle; null and empty texts, and texts of white space, are copies
of each other; repeated rows are reported one by one; a null id never names a component unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import simhash
from tillstream.llm.components import components
from tillstream.llm.names import unused
from tillstream.llm.words import SPACES, Words, blocks, grams, mix
from tillstream.session import stored

BANDS, ROWS = 32, 4
_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of each text, and where each text's begin."""
    words = Words(texts, SPACES)
    hashes, of, counts = words.hashes(), words.text_of(), np.diff(words.first)
    found = grams(hashes, n) if len(hashes) >= n else hashes[:0]
    own = np.flatnonzero(of[: len(found)] == of[n - 1 : n - 1 + len(found)])
    short = np.flatnonzero((counts > 0) & (counts < n))
    whole = [grams(hashes[words.first[k] : words.first[k + 1]], int(counts[k])) for k in short]
    gram, text = np.concatenate([found[own], *whole]), np.concatenate([of[own], short])
    order = np.lexsort((gram, text))
    gram, text = gram[order], text[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
    return gram[new], np.searchsorted(text[new], np.arange(len(texts) + 1))


def classes_of(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each text's set."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(gram ^ _SEEDS[0]))])
        return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def _keys(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The keys of each text that has shingles, by text and band."""
    begins, out = first[:-1][np.diff(first) > 0], []
    with np.errstate(over="ignore"):
        for band in range(BANDS if len(begins) else 0):
            key = np.full(len(begins), band, np.uint64)
            for k in range(band * ROWS, band * ROWS + ROWS):
                key = mix(key + np.minimum.reduceat((gram ^ _SEEDS[2 * k]) * (_SEEDS[2 * k + 1] | np.uint64(1)), begins))
            out.append(key)
    return np.stack(out, axis=1) if out else np.zeros((0, BANDS), np.uint64)


def _scanned(docs: DataFrame, doc_id: str, text: str, n: int, sets: bool, prints: bool = False) -> DataFrame:
    """`doc_id`, `class` and `hashes` of each document: its shingles, or else its keys; its SimHash `fingerprint` if wanted."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column("_text")):
                gram, first = shingles(batch.column("_text")[begin:end], n)
                values = gram if sets else _keys(gram, first).ravel()
                ends = first if sets else np.concatenate([[0], np.cumsum(BANDS * (np.diff(first) > 0))])
                found = {"doc_id": batch.column("doc_id")[begin:end], "class": pa.array(classes_of(gram, first).view(np.int64)),
                         "hashes": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))}
                if prints:
                    found["fingerprint"] = pa.array(simhash.fingerprints_of(batch.column("_text")[begin:end]))
                yield pa.record_batch(found)

    schema = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, class long, hashes array<long>"
    return own.mapInArrow(run, f"{schema}, fingerprint long" if prints else schema)


def alike(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """The pairs (`a`, `b`) of classes whose sets (`class`, `hashes`) are similar enough, counted on the whole sets."""
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("hashes").alias("_a")), "a").join(
        sets.select(F.col("class").alias("b"), F.col("hashes").alias("_b")), "b")
    same = both.select("a", "b", F.size(F.array_intersect("_a", "_b")).cast("long").alias("same"), (F.size("_a") + F.size("_b")).alias("total"))
    p, q = least.numerator, least.denominator
    return same.where((p + q) * F.col("same") >= p * F.col("total")).select("a", "b")


def rare_entries(members: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """The rarest shingles (`gram`) of each member, with its `class`, `root`, number of shingles `n` and the place `at` of the shingle.

    members: `class` and `root`; sets: `class` and `hashes`. Shingles are ordered by how many members have them. Of n
    shingles a similar pair shares so many that, in this order, the first one shared is among the first
    n - ceil(least * n) + 1 of the larger set (given here) and the first n - ceil(2 * least / (1 + least) * n) + 1 of the
    smaller one. Shingles of one member come first and match nothing, so they are counted but not given.
    """
    p, q = least.numerator, least.denominator
    own = stored(members.join(sets, "class").select("class", "root", "hashes", F.size("hashes").cast("long").alias("n")), "members")
    single = own.select("class", F.explode("hashes").alias("gram"))
    seen = single.groupBy("gram").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    ranked = single.join(seen, "gram").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("seen", "gram"))).alias("met"))
    full = own.drop("hashes").join(ranked, "class").withColumn("alone", F.col("n") - F.size("met"))
    longest = F.expr(f"n - ({p} * n + {q - 1}) div {q} + 1 - alone")
    rows = full.select("class", "root", "n", "alone", F.posexplode(F.slice("met", F.lit(1), F.greatest(F.lit(0), longest).cast("int"))).alias("at", "met"))
    return rows.select("class", "root", "n", (F.col("alone") + F.col("at")).alias("at"), F.col("met.gram").alias("gram"))


def _of_several_roots(entries: DataFrame) -> DataFrame:
    roots = entries.groupBy("gram").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low <> _high").select("gram")
    return entries.join(roots, "gram")


def rare_pairs(entries: DataFrame, least: Fraction) -> DataFrame:
    """Pairs (`a`, `b`) of classes of different roots that can be similar enough; none that is similar is left out.

    A shingle joins only where lengths and its places leave enough room for what a similar pair shares.
    """
    p, q = least.numerator, least.denominator
    open_ = _of_several_roots(entries)
    x = open_.select(*[F.col(c).alias(f"x_{c}") for c in entries.columns])
    y = open_.where(F.expr(f"at < n - ({2 * p} * n + {p + q - 1}) div {p + q} + 1")).select(*[F.col(c).alias(f"y_{c}") for c in entries.columns])
    room = F.expr(f"{p + q} * least(x_n - x_at, y_n - y_at) >= {p} * (x_n + y_n) and {q} * y_n >= {p} * x_n")
    smaller = F.expr("y_n < x_n or y_n = x_n and y_class < x_class")
    met = x.join(y, (F.col("x_gram") == F.col("y_gram")) & (F.col("x_root") != F.col("y_root")) & smaller & room)
    return met.select(F.least("x_class", "y_class").alias("a"), F.greatest("x_class", "y_class").alias("b")).distinct()


def open_links(buckets: DataFrame, links: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """The links that `links` lacks to connect all similar classes of the buckets (`key`, `class`).

    Only buckets whose members are in several components are looked at. Of each rare shingle, the member with the fewest
    shingles of its own is compared with all others first, so that edited copies of one text join in one round; what is
    still apart then makes pairs.
    """
    entries = stored(rare_entries(open_members(buckets, components(links, "a", "b")), sets, least), "rare")
    several = _of_several_roots(entries)
    centres = several.groupBy("gram").agg(F.min(F.struct("at", "class", "root")).alias("c")).select(
        "gram", F.col("c.class").alias("_class"), F.col("c.root").alias("_root"))
    star = several.join(centres, "gram").where("root <> _root").groupBy(F.least("class", "_class").alias("a"), F.greatest("class", "_class").alias("b")).agg(
        F.min(F.least("root", "_root")).alias("_x"), F.max(F.greatest("root", "_root")).alias("_y"))
    tried = stored(star, "tried")
    near = stored(alike(tried.select("a", "b"), sets, least), "near")
    roots = components(tried.join(near, ["a", "b"]), "_x", "_y").withColumnRenamed("root", "_root")
    merged = stored(entries.join(roots, F.col("root") == F.col("node"), "left").select(
        "class", F.coalesce("_root", "root").alias("root"), "n", "at", "gram"), "merged")
    rest = stored(rare_pairs(merged, least).join(tried.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    return near.union(alike(rest, sets, least))


def open_members(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """`class` and `root` of the entries (`key`, `class`) whose key has several roots; a class without root is its own."""
    placed = entries.join(roots, F.col("class") == F.col("node"), "left").select("key", "class", F.coalesce("root", "class").alias("root"))
    apart = placed.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low <> _high").select("key")
    return placed.join(apart, "key").select("class", "root").distinct()


def _set_roots(own: DataFrame, docs: DataFrame, doc_id: str, text: str, n: int, least: float) -> DataFrame:
    """`node` and `root` of the classes that links of similar sets connect; own: what a scan for keys gave."""
    entries = own.select("class", F.explode("hashes").alias("key")).distinct()
    hubs = entries.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    shared = stored(entries.join(hubs, "key"), "entries")
    sets = stored(_scanned(docs, doc_id, text, n, sets=True).join(shared.select("class").distinct(), "class", "left_semi").select(
        "class", "hashes").dropDuplicates(["class"]), "sets")
    first = shared.select("class", F.explode(F.array("low", "high")).alias("hub")).where("class <> hub").select(
        F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()
    part = Fraction(least).limit_denominator(10_000)
    links = stored(alike(first, sets, part), "links")
    return components(links.union(open_links(shared.select("key", "class"), links, sets, part)), "a", "b")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, least: float = 0.8) -> DataFrame:
    """One row per document: `doc_id` and `component_id`, the smallest id that links of similar texts reach from it."""
    own = stored(_scanned(docs, doc_id, text, n, sets=False), "keys")
    classes = own.groupBy("class").agg(F.min("doc_id").alias("_least"))
    roots = _set_roots(own, docs, doc_id, text, n, least)
    rooted = classes.join(roots, F.col("class") == F.col("node"), "left").select("class", "_least", F.coalesce("root", "class").alias("_root"))
    named = rooted.join(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), "_root").select("class", "component_id")
    return own.join(named, "class").select("doc_id", "component_id")


def near_copies_and_prints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, least: float = 0.8) -> DataFrame:
    """`near_copies` with the links of SimHash fingerprints (three-word shingles, three bits) as well.

    A row ties its component of fingerprints to its component of sets; what rows tie together is one component.
    """
    own = stored(_scanned(docs, doc_id, text, n, sets=False, prints=True), "keys")
    kinds = own.groupBy("class", "fingerprint").agg(F.min("doc_id").alias("_least"))
    by_set = _set_roots(own, docs, doc_id, text, n, least).select(F.col("node").alias("class"), F.col("root").alias("_set"))
    by_print = components(simhash.links(own, "fingerprint"), "a", "b").select(F.col("node").alias("fingerprint"), F.col("root").alias("_print"))
    tied = stored(kinds.join(by_set, "class", "left").join(by_print, "fingerprint", "left").select(
        "class", "fingerprint", "_least", F.coalesce("_set", "class").alias("_set"), F.coalesce("_print", "fingerprint").alias("_print")), "tied")
    # Rows of one component of fingerprints are together as they are; a component of sets joins those that it has several of.
    several = tied.groupBy("_set").agg(F.min("_print").alias("_low"), F.max("_print").alias("_high")).where("_low <> _high")
    edges = tied.select("_set", "_print").distinct().join(several, "_set").select(F.col("_low").alias("a"), F.col("_print").alias("b"))
    roots = components(edges, "a", "b")
    rooted = tied.join(roots, F.col("_print") == F.col("node"), "left").select("class", "fingerprint", "_least", F.coalesce("root", "_print").alias("_root"))
    named = rooted.join(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), "_root").select("class", "fingerprint", "component_id")
    return own.join(named, ["class", "fingerprint"]).select("doc_id", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, least: float = 0.8) -> DataFrame:
    """The documents whose id names their component, by fingerprints or by sets, all columns as they were."""
    name = unused(docs, "_keep")
    stay = near_copies_and_prints(docs, doc_id, text, n, least).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stay, F.col(doc_id).eqNullSafe(F.col(name)), "left_semi")
