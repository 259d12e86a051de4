"""Near duplicates by SimHash, found with an inverted index on byte positions and count filtering.

A fingerprint has eight bytes. Two that differ in three bits at most share at least five of them, and so at least four
of any seven. The index holds every fingerprint under the 35 choices of four of seven positions; pairs that meet are
tallied (equal bytes), kept from five on, and verified bit by bit. Equal fingerprints are one entry, and each pair
counts only under the first choice that it shares. Within an index entry only a spanning forest of the links leaves
the task: components stay whole, while the output of a large group is linear in its size.

Cases: null and empty texts, and texts of white space, have the fingerprint zero; texts of fewer words than a shingle
are one shingle; repeated rows are reported one by one; a null id never names a component unless all are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.components import components
from tillstream.llm.words import SPACES, Words, blocks
from tillstream.session import stored

SEED = 42
CHOICES = list(combinations(range(7), 4))
#: For each set of equal positions among the first seven: the first choice within it.
FIRST = np.array([next((k for k, c in enumerate(CHOICES) if all(s >> p & 1 for p in c)), 255) for s in range(128)], np.uint8)
#: Fingerprints of an index entry up to which all are compared; larger entries are indexed again.
DIRECT = 20_000


def _shingles(words: Words, n: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text joined by single spaces; begin and end of each shingle there; each text's shingles."""
    lengths = words.ends - words.starts
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    ends = begins + lengths
    counts = np.diff(words.first)
    each = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(each)])[:-1], each) + np.arange(each.sum())
    last = starts + np.repeat(np.minimum(counts, n) - 1, each)
    return words.joined().tobytes(), begins[starts], ends[last], each


def fingerprints_of(texts: pa.Array, n: int = 3) -> np.ndarray:
    """The 64-bit fingerprint of each text, as signed numbers."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for begin, end in blocks(texts):
        data, starts, ends, each = _shingles(Words(texts[begin:end], SPACES), n)
        full = np.flatnonzero(each)
        if not len(full):
            continue
        hashes = np.fromiter((digest(data[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.concatenate([[0], np.cumsum(each[full])])[:-1]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.uint32)
        most = (2 * ones > each[full][:, None]).astype(np.uint8)
        out[begin + full] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()
    return out.view(np.int64)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3) -> DataFrame:
    """`doc_id` and `fingerprint` (a signed 64-bit number) of each document."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fingerprint": pa.array(fingerprints_of(batch.column("_text"), n))})

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, fingerprint long")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Indices of links that join the same of n nodes as all links do, at most n - 1."""
    parent, picked, left = np.arange(n), [], np.arange(len(a))
    while len(left):
        low, high = np.minimum(parent[a[left]], parent[b[left]]), np.maximum(parent[a[left]], parent[b[left]])
        open_ = low != high
        left, low, high = left[open_], low[open_], high[open_]
        if not len(left):
            break
        roots, at = np.unique(high, return_index=True)
        picked.append(left[at])
        parent[roots] = low[at]
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return np.concatenate(picked) if picked else np.zeros(0, np.int64)


def _differing(x: np.ndarray) -> np.ndarray:
    """For XORs of fingerprints, bit p of the result says that byte p differs."""
    x = x | x >> np.uint64(4)
    x = x | x >> np.uint64(2)
    x = (x | x >> np.uint64(1)) & np.uint64(0x0101010101010101)
    with np.errstate(over="ignore"):
        return (x * np.uint64(0x0102040810204080) >> np.uint64(56)).astype(np.uint8)


def _linked(x: np.ndarray, choice: np.ndarray | int, distance: int) -> np.ndarray:
    """Which XORs are of pairs that link, and belong to this choice."""
    differ = _differing(x)
    enough = 8 - np.bitwise_count(differ) >= 8 - distance  # equal bytes, tallied
    own = FIRST[~differ & 127] == choice
    return enough & own & (np.bitwise_count(x) <= distance)


def _links(group: np.ndarray, prints: np.ndarray, choices: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked pairs within groups of neighbouring rows, thinned to a forest now and then."""
    a, b, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    at, shift = np.arange(len(group)), 1
    while True:
        at = at[at + shift < len(group)]
        at = at[group[at] == group[at + shift]]
        if not len(at):
            break
        hit = at[_linked(prints[at] ^ prints[at + shift], choices[at], distance)]
        a.append(hit)
        b.append(hit + shift)
        kept += len(hit)
        if kept > 1 << 20:
            x, y = np.concatenate(a), np.concatenate(b)
            slim = forest(x, y, len(group))
            a, b, kept = [x[slim]], [y[slim]], 0
        shift += 1
    x, y = np.concatenate(a), np.concatenate(b)
    slim = forest(x, y, len(group))
    return x[slim], y[slim]


def _large_links(prints: np.ndarray, choice: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of one large index entry: a pair shares a fifth byte, so the four positions left index it again.

    Entries that are large even then agree in five bytes; there the neighbours in the other 24 bits are looked up.
    """
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in set(range(8)) - set(CHOICES[choice]):
        byte = (prints >> np.uint64(8 * p)).astype(np.uint8)
        order = np.argsort(byte, kind="stable")
        sizes = np.bincount(byte, minlength=256)
        large = np.flatnonzero(sizes > DIRECT)
        rest = order[~np.isin(byte[order], large)]
        x, y = _links(byte[rest], prints[rest], np.full(len(rest), choice, np.uint8), distance)
        a.append(rest[x])
        b.append(rest[y])
        for value in large:
            own = order[byte[order] == value]
            x, y = _probed(prints[own], [q for q in range(8) if q != p and q not in CHOICES[choice]], choice, distance)
            a.append(own[x])
            b.append(own[y])
    x, y = np.concatenate(a), np.concatenate(b)
    slim = forest(x, y, len(prints))
    return x[slim], y[slim]


def _probed(prints: np.ndarray, positions: list[int], choice: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs among fingerprints that differ in three byte positions only: each mask of bits is looked up."""
    place = np.zeros(len(prints), np.int64)
    for k, p in enumerate(positions):
        place |= ((prints >> np.uint64(8 * p)) & np.uint64(255)).astype(np.int64) << 8 * k
    order = np.argsort(place)
    known = place[order]
    masks = np.array([sum(1 << q for q in bits) for k in range(1, distance + 1) for bits in combinations(range(24), k)])
    step = max(1, (1 << 20) // max(1, len(prints)))  # masks that are looked up at once
    a, b, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for some in (masks[k : k + step, None] for k in range(0, len(masks), step)):
        near = place ^ some
        at = np.minimum(np.searchsorted(known, near), len(known) - 1)
        found, own = order[at], np.broadcast_to(np.arange(len(prints)), near.shape)
        hit = (known[at] == near) & (found > own)
        x, y = own[hit], found[hit]
        good = _linked(prints[x] ^ prints[y], choice, distance)
        a.append(x[good])
        b.append(y[good])
        kept += int(good.sum())
        if kept > 1 << 20:
            x, y = np.concatenate(a), np.concatenate(b)
            slim = forest(x, y, len(prints))
            a, b, kept = [x[slim]], [y[slim]], 0
    return np.concatenate(a), np.concatenate(b)


def entry_links(choices: np.ndarray, keys: np.ndarray, prints: np.ndarray, distance: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Linked fingerprints within index entries; rows come sorted by choice and key."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (choices[1:] != choices[:-1])
    group = np.cumsum(new)
    sizes = np.bincount(group)
    size = sizes[group]
    small = np.flatnonzero((size > 1) & (size <= DIRECT))
    x, y = _links(group[small], prints[small], choices[small], distance)
    a, b = [prints[small[x]]], [prints[small[y]]]
    for g in np.flatnonzero(sizes > DIRECT):
        own = np.flatnonzero(group == g)
        x, y = _large_links(prints[own], int(choices[own[0]]), distance)
        a.append(prints[own[x]])
        b.append(prints[own[y]])
    return np.concatenate(a), np.concatenate(b)


def links(prints: DataFrame, column: str, distance: int = 3) -> DataFrame:
    """Pairs (`a`, `b`) of different fingerprints that connect all those `distance` bits apart at most (3 or fewer)."""
    if not 0 <= distance <= 3:
        raise ValueError("the index guarantees up to three differing bits")
    masks = [sum(0xFF << 8 * p for p in c) for c in CHOICES]
    entries = prints.select(F.col(column).alias("print")).distinct().select("print", F.posexplode(F.array(*[
        F.col("print").bitwiseAND(F.lit(m if m < 2**63 else m - 2**64).cast("long")) for m in masks])).alias("choice", "key"))
    grouped = entries.select(F.col("choice").cast("byte"), "key", "print").repartition("choice", "key").sortWithinPartitions("choice", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.uint64)]

        def give(choices, keys, found):
            a, b = entry_links(choices, keys, found, distance)
            return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            own = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            rows = [np.concatenate([old, new.view(old.dtype)]) for old, new in zip(kept, own, strict=True)]
            if not len(rows[0]):
                continue
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = len(same) if same.all() else len(same) - int(np.argmin(same[::-1]))  # the last entry may go on
            cut = 0 if same.all() else cut
            if cut:
                yield give(*(r[:cut] for r in rows))
            kept = [r[cut:] for r in rows]
        yield give(*kept)

    return grouped.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, distance: int = 3) -> DataFrame:
    """One row per document: `doc_id`, `fingerprint` and `component_id`, the smallest id that links reach from it."""
    own = stored(fingerprints(docs, doc_id, text, n), "prints")
    classes = own.groupBy("fingerprint").agg(F.min("doc_id").alias("_least"))
    roots = components(links(own, "fingerprint", distance), "a", "b")
    rooted = classes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "_least", F.coalesce("root", "fingerprint").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "_root").select("fingerprint", "component_id")
    return own.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
