"""The context tree against a plain recursive one, and the base against its formula."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tillstream.llm import context_tree
from tillstream.llm.queries import QUERIES
from tillstream.llm.words import SPACES, Words


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def stream(text, depth):
    """(context, byte) of each byte of the text."""
    data = b"\n" * depth + b" ".join(tokens(text)) + b"\n"
    return [(data[i - depth : i], data[i]) for i in range(depth, len(data))]


class PlainTree:
    def __init__(self, texts, depth):
        self.depth, self.data = depth, defaultdict(lambda: [0, 0])
        for text in texts:
            for context, byte in stream(text, depth):
                for d in range(depth + 1):
                    for k in range(8):
                        self.data[context[depth - d :], k, byte >> 8 - k][byte >> 7 - k & 1] += 1
        self.children = defaultdict(list)
        for context, k, prefix in self.data:
            if context:
                self.children[context[1:], k, prefix].append((context, k, prefix))
        self.memory = {}

    def kt(self, node):
        a, b = self.data[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, node):
        if node not in self.memory:
            kt = self.kt(node)
            if self.children[node]:
                kt = math.log(0.5) + np.logaddexp(kt, sum(map(self.weighted, self.children[node])))
            self.memory[node] = kt
        return self.memory[node]

    def one(self, context, k, prefix, d=0):
        node = (context[self.depth - d :], k, prefix)
        if node not in self.data:
            return None
        a, b = self.data[node]
        own = (b + 0.5) / (a + b + 1)
        deeper = self.one(context, k, prefix, d + 1) if d < self.depth else None
        if deeper is None:
            return own
        share = math.exp(math.log(0.5) + self.kt(node) - self.weighted(node))
        return share * own + (1 - share) * deeper

    def log2(self, text):
        total = 0.0
        for context, byte in stream(text, self.depth):
            for k in range(8):
                one = self.one(context, k, byte >> 8 - k)
                one = 0.5 if one is None else one
                total += math.log2(one if byte >> 7 - k & 1 else 1 - one)
        return total


ODD = [None, "", " \t", "É", "a", "A b\nc", "zz zz  zz", "a b c", "qqq", "Ünknown wörds", "b" * 40]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["the", "and", "thing", "ánd", "other", "This"]
    return ODD + [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(40)]


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 3.0, 10.5, 1e4 + 0.5, 1e9])
    assert np.allclose(context_tree._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)


def test_contexts():
    texts = ["Ab  c", None, "", "x"]
    grams, sizes = context_tree.contexts(Words(pa.array(texts), SPACES), 3)
    want = [int.from_bytes(c + bytes([b])) for t in texts for c, b in stream(t, 3)]
    assert grams.tolist() == want
    assert sizes.tolist() == [len(stream(t, 3)) for t in texts]


def test_scores_against_a_plain_tree(spark, corpus):
    train, test = corpus[5:], corpus
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(test)], "doc_id long, text string, score int")
    learnt = spark.createDataFrame([(t,) for t in train], "text string")
    found = {r.doc_id: r for r in context_tree.score(rows, learnt, depth=3, frequent=3).collect()}
    tree = PlainTree(train, 3)
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for i, text in enumerate(test):
        own = [*map(counts.__getitem__, tokens(text)), len(train)]
        r = found[i]
        assert r.score == pytest.approx(tree.log2(text) * math.log10(2), rel=1e-5)
        assert r.base_score == pytest.approx(sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in own), rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c > 0 for c in own), n)
        assert r.bits_per_byte == pytest.approx(-tree.log2(text) / len(stream(text, 3)), rel=1e-5)


@pytest.mark.parametrize(("depth", "entries", "chunk"), [(5, 60, 1), (4, 1, 50), (5, 1 << 19, 1 << 16), (2, 20, 9), (0, 3, 1)])
def test_no_context_is_cut(spark, corpus, monkeypatch, depth, entries, chunk):
    """Whatever number of pairs goes to all tasks, scores are those of the whole tree."""
    monkeypatch.setattr(context_tree, "CHUNK", chunk)
    train = corpus[5:40]
    rows = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    learnt = spark.createDataFrame([(t,) for t in train], "text string")
    found = {r.doc_id: r.score for r in context_tree.score(rows, learnt, depth=depth, entries=entries).collect()}
    tree = PlainTree(train, depth)
    for i, text in enumerate(corpus):
        assert found[i] == pytest.approx(tree.log2(text) * math.log10(2), rel=1e-5)


def test_nothing_to_learn_or_score(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in context_tree.score(docs, docs.where("false")).collect()}
    assert found[None].score == pytest.approx(-4 * 8 * math.log10(2))
    assert (found[1].n_tokens, found[1].n_known, found[1].train_tokens) == (1, 0, 0)
    assert found[1].base_score == pytest.approx(0.0)
    assert context_tree.score(docs.where("false"), docs).count() == 0


def test_query(spark, sf):
    rows = QUERIES["op8_context_tree"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) * math.log2(10) > -3.3 * sum(len(t) for t in [b"".join(w + b" " for w in tokens(x.text)) for x in spark.read.parquet(f"{sf}/documents.parquet").collect() if zlib.crc32(str(x.doc_id).encode()) % 10 == 0])
