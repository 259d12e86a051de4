"""Words of many texts at once: byte positions and 64-bit hashes, worked out with numpy over Arrow buffers.

A text is cut at bytes, never at characters, so any input works. Nulls count as empty texts. Hashes depend on the
word's bytes alone (after lower-casing A-Z), not on its place, its text or the machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that end a word: ASCII white space only.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True

#: Bytes that end a word where punctuation does not count: everything ASCII but letters and digits.
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(known, out=known)
        _powers[str(base)] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all places."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of some bytes, which depends on its bytes and length alone."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def blocks(texts: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes, one row at least, so that a worker's memory follows the longest text."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield begin, i
            begin, total = i, 0
        total += int(n)
    if begin < len(lengths):
        yield begin, len(lengths)


class Words:
    """The words of some texts, in order.

    data: the lower-cased bytes, each text followed by a space; starts, ends: of each word in data; first: for each
    text, the index of its first word, and at the end the number of words; begins: where each text begins in data.
    """

    def __init__(self, texts: pa.Array, ends: np.ndarray = SPACES):
        full = pc.fill_null(texts.cast(pa.large_binary()), b"")
        spaced = pc.binary_join_element_wise(full, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
        if isinstance(spaced, pa.ChunkedArray):
            spaced = spaced.combine_chunks()
        offsets = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
        raw = spaced.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and len(spaced) else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]] if len(spaced) else data
        self.begins = offsets - offsets[0]
        self.data = LOWER[data]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~ends[self.data]
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.starts, self.begins)

    def joined(self, gap: int = 32) -> np.ndarray:
        """The bytes of all words, each with a byte `gap` after it."""
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] = 1
        inside[self.ends] = -1
        keep = np.cumsum(inside[:-1]).astype(bool)
        after = np.zeros(len(self.data), bool)
        after[self.ends] = True
        return np.where(after, np.uint8(gap), self.data)[keep | after]

    def hashes(self, *prefixes: int) -> np.ndarray | list[np.ndarray]:
        """A 64-bit hash of each word; with prefixes, a list: of the words, then of their first so many bytes."""
        n = len(self.data)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
            shift, out = _power(_INVERSE, n)[self.starts], []
            for ends in (self.ends, *(np.minimum(self.ends, self.starts + k) for k in prefixes)):
                out.append(mix((sums[ends] - sums[self.starts]) * shift + (ends - self.starts).astype(np.uint64)))
        return out if prefixes else out[0]

    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 words of all have none."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
        for k in range(n):
            out = out * _BASE + hashes[k : len(hashes) - n + 1 + k]
        return mix(out)
