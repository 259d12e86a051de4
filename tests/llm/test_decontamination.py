"""Leaks against an alignment of every document with every item."""

import random
import re

import numpy as np
import pytest

from tillstream.llm import decontamination


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain_align(item, passage):
    best, above = 0, [0] * (len(passage) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(passage):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def fast_align(item, passage):
    """The same, cell by cell along the item for all passage words at once: a step to the left costs one a word."""
    passage = np.array(passage)
    place, above, best = np.arange(len(passage) + 1), np.zeros(len(passage) + 1, int), 0
    for a in item:
        row = np.zeros(len(passage) + 1, int)
        row[1:] = np.maximum(np.maximum(above[:-1] + np.where(passage == a, 2, -1), above[1:] - 1), 0)
        above = np.maximum.accumulate(row + place) - place
        best = max(best, int(above.max()))
    return best


def edited(item, share, rng):
    out = []
    for w in item.split():
        kind = rng.random()
        out += [w] if kind > share else rng.choice([[], ["changed"], [w, "added"]])
    return " ".join(out)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)] + ["été", "The"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, text(rng.randint(12, 60))) for k in range(25)]
    items += [(50, items[3][1].upper()), (51, "too short"), (52, None), (53, ""), (None, text(20)), (None, text(25)), (54, text(18)), (54, text(22))]
    docs = [(k, text(rng.randint(0, 300))) for k in range(40)]
    for k in range(60):
        item = items[k % 25][1]
        docs.append((100 + k, f"{text(rng.randint(0, 80))} {edited(item, rng.choice([0, 0, 0.1, 0.25, 0.6]), rng)}, {text(rng.randint(0, 200))}"))
    docs += [(200, items[0][1].replace(" ", "; ")), (201, " ".join(items[1][1].split()[:6])), (202, None), (203, ""), (204, "w1 " * 50_000 + items[2][1]),
             (205, items[4][1]), (205, items[4][1]), (None, items[5][1]), (206, " ".join([items[7][1]] * 300))]
    docs += [(300 + k, f"{text(9)} {items[-1 - k][1]} {text(9)}") for k in range(4)] + [(310, items[3][1])]
    return docs, items


@pytest.fixture(scope="module")
def tables(spark, case):
    docs, items = case
    return (spark.createDataFrame([(i, t, "x", 0.1) for i, t in docs], "doc_id long, text string, _leak string, score double"),
            spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int"))


def test_leaks_against_all_pairs(case, tables):
    docs, items = case
    found = {(r.doc_id, r.item_id): r for r in decontamination.leaks(*tables).collect()}
    want = {}
    for d, text in docs:
        own = words(text)
        for i, item in items:
            item = words(item)
            if len(item) < 4:
                continue
            score = (fast_align if len(own) > 2000 else plain_align)(item, own) / (2 * len(item))
            if score >= 0.6:
                want[d, i] = max(score, want.get((d, i), 0))
    assert found.keys() == want.keys()
    assert len(want) > 45 and {(310, 3), (310, 50), (300, 54), (302, None), (303, None)} <= want.keys()
    for key, r in found.items():
        assert r.score == pytest.approx(want[key])
        assert r.end_word > r.first_word


def test_spans(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.createDataFrame([(1, f"one two {item} three"), (2, f"{item.replace('gamma', 'x')} q r s")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = {r.doc_id: (r.score, r.first_word, r.end_word) for r in decontamination.leaks(docs, bench).collect()}
    assert found == {1: (1.0, 2, 10), 2: (13 / 16, 0, 8)}


def test_align_by_rows():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 30))
        score, first, end = decontamination.align(a, b)
        assert score == plain_align(a.tolist(), b.tolist())
        assert plain_align(a.tolist(), b[first:end].tolist()) == score


def test_without_leaks(case, tables):
    docs, _ = case
    leaks = {r.doc_id for r in decontamination.leaks(*tables).collect()}
    kept = decontamination.without_leaks(*tables)
    assert kept.columns == tables[0].columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in leaks)


def test_empty(tables):
    docs, bench = tables
    assert decontamination.leaks(docs.where("false"), bench).count() == 0
    assert decontamination.leaks(docs, bench.where("false")).count() == 0
    assert decontamination.without_leaks(docs, bench.where("false")).count() == docs.count()
