"""Token ids of many texts at once, each distinct word tokenized once.

A tokenizer that never joins letters across the beginning of a word gives a text the ids of its words in order. Words
are cut in numpy and told apart by Arrow's dictionary encoding, so only distinct words of a block are looked up, and
only words that were never met are tokenized, in runs of many. What is remembered is flat: the words' bytes, their ids and a sorted
array of their hashes, some 40 bytes a word. A hash only says where to look; the bytes decide.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from tillstream.llm.words import span_hashes

#: Words that are remembered; beyond, those not met since the last time go.
REMEMBERED = 1 << 20
#: Bytes of new words that are tokenized in one run.
RUN = 1 << 12

_SPACE = 32
#: Bytes that may begin white space: no word is known to begin after a space before one of them.
_MAY_BE_SPACE = np.zeros(256, bool)
_MAY_BE_SPACE[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def flat(binary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each one begins and the last one ends. Nulls count as empty."""
    own = binary.combine_chunks() if isinstance(binary, pa.ChunkedArray) else binary
    own = own.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1] if len(own) else np.zeros(1, np.int64)
    raw = own.buffers()[2] if len(own) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices begin .. begin + length - 1 of all spans, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """Ids of texts by one tokenizer.

    encode: ids of a text; sizes: bytes that each id stands for; cut: given bytes, where words begin in them (besides
    the beginnings of texts); lead: whether a space stands before each text that its encoder adds by itself.
    """

    def __init__(self, encode: Callable[[str], list[int]], sizes: np.ndarray, cut: Callable[[np.ndarray], np.ndarray], lead: bool):
        self.encode, self.sizes, self.cut, self.lead = encode, sizes, cut, lead
        self.forget()

    def forget(self) -> None:
        """Drop all remembered words."""
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and whose they are
        self.ids, self.id_ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.bytes, self.byte_ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.met = np.zeros(0, bool)

    def of(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin in them and the last one's end.

        data: the texts' bytes one after the other; begins: where each one begins, and the end.
        """
        mark = np.zeros(len(data) + 1, bool)
        mark[begins] = True
        mark[self.cut(data)] = True
        mark[len(data)] = False
        starts = np.flatnonzero(mark)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy()
        ids, ends = self._distinct(*flat(coded.dictionary))
        lengths = np.diff(ends)[which]
        out = ids[spans(ends[:-1][which], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return out, total[np.searchsorted(starts, begins)]

    def _distinct(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and where each one's begin."""
        lengths, hashes = np.diff(ends), span_hashes(data, ends[:-1], ends[1:])
        found = self._known(data, ends, hashes)
        new = np.flatnonzero(found < 0)
        new_ids, new_ends = self._tokenized(data, ends, new)
        old = found >= 0
        self.met[found[old]] = True
        counts = np.zeros(len(lengths), np.int64)
        counts[old] = np.diff(self.id_ends)[found[old]]
        counts[new] = np.diff(new_ends)
        out_ends = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(out_ends[-1], np.uint32)
        out[spans(out_ends[:-1][old], counts[old])] = self.ids[spans(self.id_ends[:-1][found[old]], counts[old])]
        out[spans(out_ends[:-1][new], counts[new])] = new_ids
        self._remember(data, ends, new, hashes[new], new_ids, new_ends)
        return out, out_ends

    def _known(self, data: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The entry of each word, or -1."""
        if not len(self.keys) or not len(hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        entry, lengths = self.entry[at].astype(np.int64), np.diff(ends)
        same = (self.keys[at] == hashes) & (np.diff(self.byte_ends)[entry] == lengths)
        rows = np.flatnonzero(same)
        equal = self.bytes[spans(self.byte_ends[:-1][entry[rows]], lengths[rows])] == data[spans(ends[:-1][rows], lengths[rows])]
        wrong = np.concatenate([[0], np.cumsum(~equal)])
        upto = np.concatenate([[0], np.cumsum(lengths[rows])])
        same[rows] = wrong[upto[1:]] == wrong[upto[:-1]]
        return np.where(same, entry, -1)

    def _tokenized(self, data: np.ndarray, ends: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the new words: those that a word may stand before in runs, others on their own."""
        begins, lengths = ends[:-1][new], np.diff(ends)[new]
        joinable = np.zeros(len(new), bool)
        first = np.flatnonzero(lengths > 1)
        joinable[first] = (data[begins[first]] == _SPACE) & ~_MAY_BE_SPACE[data[begins[first] + 1]]
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(new), np.int64)
        order = np.concatenate([np.flatnonzero(joinable), np.flatnonzero(~joinable)])
        own = data[spans(begins[order], lengths[order])].tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths[order])])
        joined = int(joinable.sum())
        runs, at = [], 0
        while at < joined:
            end = max(at + 1, int(np.searchsorted(upto[: joined + 1], upto[at] + RUN, "right")) - 1)
            runs.append((at, end))
            at = end
        for a, b in runs + [(k, k + 1) for k in range(joined, len(new))]:
            found = self._run(own[upto[a] : upto[b]])
            ends_of = np.cumsum(self.sizes[found])
            cuts = np.searchsorted(ends_of, upto[a + 1 : b + 1] - upto[a])
            if b - a == 1:
                cuts = np.array([len(found) - 1])
            elif not len(ends_of) or cuts[-1] + 1 != len(found) or not np.array_equal(ends_of[cuts], upto[a + 1 : b + 1] - upto[a]):
                parts = [self._run(own[upto[k] : upto[k + 1]]) for k in range(a, b)]  # ids that stand for other bytes
                found, cuts = np.concatenate(parts), np.cumsum([len(p) for p in parts]) - 1
            ids.append(found)
            counts[order[a:b]] = np.diff(cuts, prepend=-1)
        flat_ids = np.concatenate(ids)
        in_order = np.concatenate([[0], np.cumsum(counts[order])])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return flat_ids[spans(in_order[:-1][back], counts)], np.concatenate([[0], np.cumsum(counts)])

    def _run(self, text: bytes) -> np.ndarray:
        return np.array(self.encode((text[1:] if self.lead else text).decode()), np.uint32)

    def _remember(self, data: np.ndarray, ends: np.ndarray, new: np.ndarray, hashes: np.ndarray, ids: np.ndarray, id_ends: np.ndarray) -> None:
        if not len(new):
            return
        if len(self.keys) > REMEMBERED:
            self._shrink()
        lengths, first = np.diff(ends)[new], len(self.met)
        self.bytes = np.concatenate([self.bytes, data[spans(ends[:-1][new], lengths)]])
        self.byte_ends = np.concatenate([self.byte_ends, self.byte_ends[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        self.id_ends = np.concatenate([self.id_ends, self.id_ends[-1] + id_ends[1:]])
        self.met = np.concatenate([self.met, np.ones(len(new), bool)])
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.keys, hashes[order])
        self.keys = np.insert(self.keys, at, hashes[order])
        self.entry = np.insert(self.entry, at, (first + order).astype(np.int32))

    def _shrink(self) -> None:
        """Keep the words that were met since the last time, or none if they are too many."""
        keep = np.flatnonzero(self.met) if self.met.sum() <= REMEMBERED // 2 else np.zeros(0, np.int64)
        place = np.full(len(self.met), -1, np.int64)
        place[keep] = np.arange(len(keep))
        for values, ends in (("bytes", "byte_ends"), ("ids", "id_ends")):
            old, upto = getattr(self, values), getattr(self, ends)
            lengths = np.diff(upto)[keep]
            setattr(self, values, old[spans(upto[:-1][keep], lengths)])
            setattr(self, ends, np.concatenate([[0], np.cumsum(lengths)]))
        stay = place[self.entry] >= 0
        self.keys, self.entry = self.keys[stay], place[self.entry[stay]].astype(np.int32)
        self.met = np.zeros(len(keep), bool)


def _before_words(data: np.ndarray) -> np.ndarray:
    """Spaces that a word follows. The byte-level pretokenizer always cuts there."""
    space = np.flatnonzero(data[:-1] == _SPACE)
    return space[~_MAY_BE_SPACE[data[space + 1]]]


def _after_words(data: np.ndarray) -> np.ndarray:
    """Spaces after something else. No piece goes on from there to a space."""
    return np.flatnonzero((data[1:] == _SPACE) & (data[:-1] != _SPACE)) + 1


def byte_level(path: str | None = None) -> WordIds:
    """A byte-level tokenizer; names of special tokens in a text are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
    own = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return WordIds(lambda text: own.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.array([len(b) for b in byte_level_bytes(own)]), _before_words, False)


def byte_level_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes that each id of a byte-level tokenizer stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    out = [b""] * (max(tokenizer.get_vocab().values(), default=-1) + 1)
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else b""
    return out


def pieces(path: str | None = None) -> WordIds:
    """A tokenizer of pieces, which puts a space before a text by itself."""
    own = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    space = [own.piece_to_id("▁")]  # a single space after the last word; as a text of its own it would be empty
    return WordIds(lambda text: own.encode(text, num_threads=1) or space, np.array([len(b) for b in piece_bytes(own)]), _after_words, True)


def piece_bytes(own: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes that each piece stands for; none for unknown and control pieces."""
    out = []
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        if own.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if own.is_unknown(i) or own.is_control(i) else piece.replace("▁", " ").encode())
    return out
