"""One-permutation sketches and near duplicates against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tillstream.llm import minhash, similar
from tillstream.llm.queries import QUERIES


def plain_set(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain_result(rows, n=3, p=85, q=100):
    """(id, set size, component, kept) of each row, by comparing all."""
    sets = [plain_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    of = {}
    for i, s in enumerate(sets):
        for g in s:
            of.setdefault(g, []).append(i)
    for i, a in enumerate(sets):
        for j in {j for g in a for j in of[g] if j < i}:
            common = len(a & sets[j])
            if q * common >= p * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        old = least.get(find(i))
        least[find(i)] = k if old is None else old if k is None else min(k, old)
    return [(k, len(sets[i]), least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def edited(words, changes, rng, vocabulary):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = rng.choice(vocabulary)
    return words


def made_rows(seed):
    """Edited copies around the threshold, chains, a large group, texts with much in common that are not similar, odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    texts = [None, "", " ", "\t\n", "a", "A", "one two", "ONE  two", "one two three", "one two three four", "Éa b c", "éa b c"]
    for size in (5, 6, 7, 8, 10, 20, 40, 80, 160, 320):
        for _ in range(8):
            base = rng.choices(vocabulary, k=size)
            texts += [" ".join(edited(base, k, rng, vocabulary)) for k in range(4)]
            texts += [" ".join(base + rng.choices(vocabulary, k=k)) for k in range(1, 4)]
            chain = base
            for _ in range(3):
                chain = edited(chain, max(1, size // 60), rng, vocabulary)
                texts.append(" ".join(chain))
    group = rng.choices(vocabulary, k=150)
    texts += [" ".join(edited(group, rng.randint(0, 3), rng, vocabulary)) for _ in range(60)]
    passage = rng.choices(vocabulary, k=98)
    texts += [" ".join(passage + rng.choices(vocabulary, k=20)) for _ in range(150)]
    last = [" ".join(passage + rng.choices(vocabulary, k=6)) for _ in range(30)]
    texts += last + [t + " end" for t in last]
    texts += [" ".join(rng.choices(vocabulary, k=30_000))] * 2
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = made_rows(seed)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, class string, kept int").repartition(7)
    found = minhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = plain_result(rows)
    assert ordered(found.collect()) == ordered(want)
    assert 20 < len({r[2] for r in want if r[1]}) < len(rows)


def test_only_the_star_and_the_prefix_filter_make_pairs(spark, monkeypatch):
    """Texts with 96 common shingles and none similar: no pair is compared but those of the star."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(100_000)]
    passage = rng.choices(vocabulary, k=98)
    docs = spark.createDataFrame([(k, " ".join(passage + rng.choices(vocabulary, k=20))) for k in range(600)], "doc_id long, text string")
    seen = []
    whole = similar.alike
    for module in (minhash, similar):
        monkeypatch.setattr(module, "alike", lambda pairs, sets, least: (seen.append(pairs.count()), whole(pairs, sets, least))[1])
    found = minhash.near_duplicates(docs).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in found) and len(found) == 600
    assert seen[0] < 600 * minhash.BANDS and seen[1] < 600 and seen[2] == 0


def test_edited_copies_of_one_text_join_by_stars(spark, monkeypatch):
    """Copies with up to eight words changed: those near the original join through it, the others make no pairs."""
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(100_000)]
    base = rng.choices(vocabulary, k=150)
    rows = [(k, " ".join(edited(base, k % 9, rng, vocabulary))) for k in range(400)]
    seen = []
    whole = similar.alike
    for module in (minhash, similar):
        monkeypatch.setattr(module, "alike", lambda pairs, sets, least: (seen.append(pairs.count()), whole(pairs, sets, least))[1])
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert ordered(found) == ordered(plain_result(rows))
    assert sum(seen) < 400 * minhash.BANDS and seen[2] < 1000


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "a b c d"), (7, "A b c d"), (7, "a b c d"), (None, "solo"), (None, ""), (3, ""), (3, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(minhash.near_duplicates(docs).collect()) == ordered([
        (None, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (None, 1, None, True), (None, 0, None, True), (3, 0, 3, True), (3, 0, 3, True), (4, 0, 4, True)])


def test_empty_table_and_kept_documents(spark):
    docs = spark.createDataFrame([(1, "x y", "k"), (2, "X  y", "k")], "doc_id long, text string, _keep string")
    assert minhash.near_duplicates(docs.where("false")).count() == 0
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "x y", "k")]


@pytest.mark.parametrize("size", [1, 2, 7, 30, 100, 1000])
def test_densified_bins_agree_as_the_sets_do(size):
    """The share of equal bins estimates the similarity, with hardly any and with many shingles."""
    rng = np.random.default_rng(size)
    other = max(1, size // 8)
    pairs, gram = 400, []
    for _ in range(pairs):
        both = rng.integers(0, 2**64, size, np.uint64)
        gram += [np.sort(both), np.sort(np.concatenate([both[: size - other // 2], rng.integers(0, 2**64, other, np.uint64)]))]
    first = np.concatenate([[0], np.cumsum([len(g) for g in gram])])
    sketch, full = minhash.sketches(np.concatenate(gram), first)
    assert len(full) == 2 * pairs and (sketch != 0).all()
    for row, own in zip(sketch[:20], gram, strict=False):
        assert set(row) <= set(own)
    same = (sketch[::2] == sketch[1::2]).mean()
    true = np.mean([len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(gram[::2], gram[1::2], strict=True)])
    assert abs(same - true) < 0.05


def test_a_filled_bin_keeps_its_least_hash():
    rng = np.random.default_rng(0)
    own = np.sort(rng.integers(0, 2**64, 5000, np.uint64))
    sketch, _ = minhash.sketches(own, np.array([0, 5000]))
    bins = [int(h) * minhash.BINS >> 64 for h in own.tolist()]
    least = {}
    for b, h in zip(bins, own.tolist(), strict=True):
        least.setdefault(b, h)
    assert all(int(sketch[0, b]) == h for b, h in least.items())
    assert len(similar.shingles(pa.array(["a b c"]), 3)[0]) == 1


def test_query_on_a_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert ordered(QUERIES["op11_minhash"](spark, sf).collect()) == ordered(plain_result(rows))
