"""Words and the classifier: hashes by hand, held-out accuracy on planted texts, odd input."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillstream.llm import toxicity
from tillstream.llm.queries import QUERIES
from tillstream.llm.words import MARKS, SPACES, Words, blocks


def test_words_of_texts():
    texts = ["Ab  cÉ,d", None, "", " x", "ab", "É!", "a\tb\n"]
    for ends, pattern in ((SPACES, rb"[^\x20\x09-\x0D]+"), (MARKS, rb"[0-9A-Za-z\x80-\xff]+")):
        w = Words(pa.array(texts), ends)
        found = [[w.data[s:e].tobytes() for s, e in zip(w.starts[a:b], w.ends[a:b])] for a, b in zip(w.first, w.first[1:])]
        assert found == [re.findall(pattern, (t or "").encode().lower()) for t in texts]


def test_hashes_depend_on_the_word_alone():
    w = Words(pa.array(["one two", "zz two ONE", "twin"]), SPACES)
    full, stem = w.hashes(2)
    names = [w.data[s:e].tobytes() for s, e in zip(w.starts, w.ends)]
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert (full[i] == full[j]) == (a == b)
            assert (stem[i] == stem[j]) == (a[:2] == b[:2])


def test_blocks_cover_all_rows():
    texts = pa.array(["x" * n for n in (5, 0, 9, 100, 1)] + [None])
    assert [*blocks(texts, 10)] == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert [*blocks(pa.array([], pa.string()))] == []


def planted(n, seed):
    rng = random.Random(seed)
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 60))
        bad = i % 5 == 0
        if bad:
            for w in rng.choices(["nasty", "vile", "brutish" + rng.choice("abcdef")], k=2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = planted(1500, 1)
    table = spark.createDataFrame(rows, "doc_id long, text string, label int")
    return toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "label"), "label")


def test_held_out_accuracy(spark, model):
    rows = planted(600, 2)
    assert len(model.places) < 400
    found = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, label int"), model).collect()}
    right = sum(found[i].predicted == y for i, _, y in rows)
    assert right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_texts(spark, model):
    rows = [(1, None, 9.0), (2, "", 9.0), (2, "", 9.0), (None, "nasty vile", 9.0), (4, "w1 " * 100_000, 9.0), (5, "nasty vile " * 100_000, 9.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    found = [(r.doc_id, r.score, r.predicted) for r in toxicity.score(docs, model).collect()]
    assert len(found) == len(rows)
    assert len({s for i, s, _ in found if i in (1, 2)}) == 1
    assert {i: p for i, _, p in found} == {1: 0, 2: 0, None: 1, 4: 0, 5: 1}
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 4]
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (7, 1)], "doc_id long, label int")
    model = toxicity.train(docs, labels, "label")
    assert len(model.places) == 0
    assert toxicity.score(docs, model).first().score == 0.5


def test_one_step_by_hand():
    ftrl = toxicity.Ftrl(alpha=0.5, beta=1.0, l1=0.1, l2=0.0, bias=0.0)
    ftrl.learn(np.array([3, 8]), 1)  # p = 0.5, gradient -0.5
    assert np.allclose(ftrl.z[[3, 8]], -0.5)
    assert np.allclose(ftrl.n[[3, 8]], 0.25)
    assert np.allclose(ftrl.weight(ftrl.z[[3]], np.sqrt(ftrl.n[[3]])), 0.4 / (1.5 / 0.5))


def plain_run(rows, alpha=0.3, beta=1.0, l1=3.0, l2=1e-3):
    """FTRL-proximal with one entry per feature by name; rows in order. Gives the score of a text."""
    def names(text):
        w = re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())
        return {("word", x) for x in w} | {(k, x[:k]) for k in (4, 6) for x in w} | {(gap, a, b) for gap in (-1, -2) for a, b in zip(w, w[-gap:])}

    ones = sum(y for _, y in rows)
    bias = math.log((ones + 0.5) / (len(rows) - ones + 0.5))
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        return -math.copysign(max(abs(z[f]) - l1, 0.0), z[f]) / ((beta + math.sqrt(n[f])) / alpha + l2)

    def score(text):
        return 1 / (1 + math.exp(-bias - sum(weight(f) for f in names(text))))

    for text, label in rows:
        slope = score(text) - label
        for f, w in [(f, weight(f)) for f in names(text)]:
            z[f] += slope - (math.sqrt(n[f] + slope * slope) - math.sqrt(n[f])) / alpha * w
            n[f] += slope * slope
    return score


def test_whole_run_against_plain_features(spark):
    """Training and scores over documents in the order of their ids' hashes, against features that are not hashed."""
    rng = random.Random(3)  # a small vocabulary, so that no two features share a coordinate
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(18)], k=rng.randint(2, 30)) + ["brutish"] * (i % 5 == 0)), int(i % 5 == 0)) for i in range(400)] + [(1000, "", 1), (1001, "Nasty nasty\tNASTY", 1), (1002, "é ÉA w1", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    order = [r.doc_id for r in table.select("doc_id").orderBy(F.xxhash64("doc_id")).collect()]
    by_id = {i: (t, y) for i, t, y in rows}
    score = plain_run([by_id[i] for i in order])
    model = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "label"), "label")
    found = toxicity.score(table, model).collect()
    assert len(found) == len(rows) and len(model.places) > 5
    for r in found:
        assert r.score == pytest.approx(score(by_id[r.doc_id][0]), abs=1e-5)


def test_query_on_the_table(spark, sf):
    rows = QUERIES["op1_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
