"""Packing: ids against the tokenizer, sequences without overlap or gap, few of them."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillstream.llm import packing, wordids

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a  b", "a \n b", "a\n b", "a\n \nb", "x  y", "x  y", "tab\t\ttab \t t", "don't we'll",
       "<|endoftext|> end<|endoftext|>", "ñandú Éa 12345 #$% ...", "a\r\n\r\nb c", "trailing ", "日本 語\n\n\n", "é ​ x", "﻿a b"]


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(words, texts):
    ids, at = words.of(*wordids.flat(pa.array([None if t is None else t.encode() for t in texts], pa.binary())))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]


PARTS = ["a", "Bc", " ", " ", "\n", "\t", "é", "1", ".", "\u00a0", "'s", "\u3000", "  ", "日本", "\u0085", "\x1c", "don't", " x", "<|endoftext|>", "</s>"]


def odd_texts(seed):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choices(PARTS, k=rng.randint(1, 30))) for _ in range(3000)]


@pytest.mark.parametrize("remembered", [1 << 20, 50])
def test_ids_of_odd_texts(tokenizer, monkeypatch, remembered):
    """The ids of whole texts, from words that are new, remembered or forgotten again."""
    monkeypatch.setattr(wordids, "REMEMBERED", remembered)
    own = wordids.byte_level(PATH)
    texts = odd_texts(0)
    for _ in range(2):
        for k in range(0, len(texts), 700):
            assert ids_of(own, texts[k : k + 700]) == [plain(tokenizer, t)[:-1] for t in texts[k : k + 700]]
    assert ids_of(own, [None, "a", None]) == [[], plain(tokenizer, "a")[:-1], []]
    assert ids_of(own, []) == []
    own.forget()
    assert ids_of(own, texts[:100]) == [plain(tokenizer, t)[:-1] for t in texts[:100]]


def test_words_of_equal_hashes(tokenizer, monkeypatch):
    """A hash only says where to look: with one for all words, ids are still right."""
    monkeypatch.setattr(wordids, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    own = wordids.byte_level(PATH)
    for _ in range(2):
        assert ids_of(own, ODD) == [plain(tokenizer, t)[:-1] for t in ODD]


def test_pieces_of_words():
    """The piece tokenizer's ids, which puts a space before each text."""
    whole = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own = wordids.pieces()
    texts = [t for t in odd_texts(1) if t]
    assert ids_of(own, [" " + t for t in texts]) == [whole.encode(t) for t in texts]


def check_bins(counts, bins, capacity):
    used = Counter()
    for b in bins:
        assert b.count > 0 and sum(b.lengths) + b.gap == capacity and b.gap >= 0
        assert sum(3 * n > capacity for n in b.lengths) <= 2
        for n in b.lengths:
            used[n] += b.count
    assert used == Counter({n: c for n, c in counts.items() if c})


@pytest.mark.parametrize("seed", range(8))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 30, 100, 1024])
    counts = {n: rng.choice([1, 3, 50, 10**6]) for n in rng.sample(range(1, capacity + 1), min(capacity, rng.randint(1, 60)))}
    bins = packing.plan(counts, capacity)
    check_bins(counts, bins, capacity)
    total = -(-sum(n * c for n, c in counts.items()) // capacity)
    halves = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert sum(b.count for b in bins) <= 1.23 * max(total, halves) + 2


def test_plan_of_a_known_case():
    bins = packing.plan({6: 2, 4: 2, 3: 2, 1: 2}, 10)
    assert sum(b.count for b in bins) == 3
    assert packing.plan({}, 10) == []
    with pytest.raises(ValueError, match="tokens"):
        packing.plan({11: 1}, 10)


def test_pack_and_sequences(spark, tokenizer):
    rng = random.Random(5)
    rows = list(enumerate(ODD)) + [(100, None), (100, None), (101, "same text"), (101, "same text"), (None, "no id")]
    rows += [(200 + k, " ".join(rng.choices(["alpha", "beta", "gamma", "Ünder"], k=rng.randint(1, 400)))) for k in range(60)]
    rows += [(300, "long text " * 3000), (301, "x")]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, offset int")
    found = packing.pack(docs).collect()
    want = Counter()
    for i, t in rows:
        ids = plain(tokenizer, t)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(k[3] * n for k, n in want.items())
    assert len(places) <= -(-total // 1024) + 2

    full = {r.sequence_id: r for r in packing.sequences(docs).collect()}
    assert Counter(t for r in full.values() for t in r.ids) == Counter(t for _, x in rows for t in plain(tokenizer, x))
    assert sum(len(r.doc_ids) for r in full.values()) == len(found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0
