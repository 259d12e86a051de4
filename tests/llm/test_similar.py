"""Near copies against all pairs."""

import random

from tillstream.llm import simhash, similar


def plain_sets(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain_components(rows):
    sets = [plain_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) / len(a | b) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(k, least.get(find(i), k))
    return {k: least[find(i)] for i, (k, _) in enumerate(rows)}


def test_against_all_pairs(spark):
    """Edited copies around the threshold, chains of them, a large group, short and empty texts."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]

    def edited(words, changes):
        words = list(words)
        for at in rng.sample(range(len(words)), changes):
            words[at] = rng.choice(vocabulary)
        return words

    texts = [None, "", " ", "a", "A", "one two", "one two three four five", "one two three four five six"]
    for size in (25, 60, 120, 240):
        for _ in range(8):
            base = rng.choices(vocabulary, k=size)
            texts += [" ".join(edited(base, k * size // 120)) for k in range(6)]
            chain = base
            for _ in range(3):
                chain = edited(chain, max(1, size // 60))
                texts.append(" ".join(chain))
    group = rng.choices(vocabulary, k=150)
    texts += [" ".join(edited(group, rng.randint(0, 4))) for _ in range(60)]
    rows = list(enumerate(texts))
    found = {r.doc_id: r.component_id for r in similar.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_components(rows)
    assert found == want
    assert len(set(want.values())) < len(rows) / 2


def test_pipeline_stage_drops_edited_copies(spark):
    """One word in a hundred changed: more than three bits of a fingerprint, but a similarity of 0.9."""
    import corpus_pipeline

    rng = random.Random(6)
    rows = []
    for k in range(20):
        words = [f"w{rng.randrange(3000)}" for _ in range(100)]
        rows += [(k, " ".join(words)), (100 + k, " ".join([*words[:50], "changed", *words[51:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(20))


def test_odd_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "solo"), (7, "a b c"), (7, "a b c"), (None, "A b  c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in similar.near_copies(docs).collect()) == [(0, 0), (0, 7), (7, 7), (7, 7)]
    assert similar.one_of_each(docs.where("false")).count() == 0


def test_fingerprints_and_sets_together(spark):
    """Repeated lines with different tails: fingerprints see the repetition, sets do not; one component has links of both kinds."""
    rng = random.Random(6)
    text = lambda name, n: " ".join(f"{name}{rng.randint(0, 10**6)}" for _ in range(n))
    line = " ".join(f"line{k}" for k in range(11))
    tails = [text("t", 40) for _ in range(3)]
    tailed = [f"{(line + ' ') * 60}{tail}" for tail in tails]
    body = text("b", 400).split()
    # Of `body`, an edit of 30 words has similar sets and (tested below) another fingerprint.
    edited = [w if k >= 30 else f"x{k}" for k, w in enumerate(body)]
    chained = f"{' '.join(edited)} {text('e', 3)}"
    rows = [(1, tailed[0]), (2, tailed[1]), (3, tailed[2]), (4, f"{line} {tails[1]}"), (10, " ".join(body)), (11, " ".join(edited)), (12, chained),
            (20, text("u", 50)), (20, text("v", 50)), (21, None), (22, " "), (None, tailed[0]), (None, text("n", 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in simhash.fingerprints(docs.where("doc_id < 20")).collect()}
    assert len({prints[k] for k in (1, 2, 3)}) == 1
    assert all(((prints[a] ^ prints[b]) & 2**64 - 1).bit_count() > 3 for a, b in ((2, 4), (10, 11)))
    assert {r.component_id for r in similar.near_copies(docs.where("doc_id < 5")).collect()} == {1, 2, 3}
    found = [(r.doc_id, r.component_id) for r in similar.near_copies_and_prints(docs).collect()]
    want = [(1, 1), (2, 1), (3, 1), (4, 1), (10, 10), (11, 10), (12, 10), (20, 20), (20, 20), (21, 21), (22, 21), (None, 1), (None, None)]
    order = lambda row: (row[0] is None, row[0] or 0, row[1] is None)
    assert sorted(found, key=order) == want
    assert [r.doc_id for r in similar.one_of_each(docs.where("doc_id < 20")).orderBy("doc_id").collect()] == [1, 10]
