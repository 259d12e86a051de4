"""Each stage's decision takes effect, and nothing clean is lost."""

import random

import pytest

import corpus_pipeline
from tillstream.llm import decontamination, toxicity
from tillstream.llm.queries import toxic_model


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus of planted cases next to plain documents."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(2000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(k, text(30)) for k in range(5)]
    docs = [(k, text(rng.randint(60, 300))) for k in range(300)]
    docs += [(1000 + k, f"{text(20)} vile nasty {text(40)}") for k in range(80)]
    docs += [(2000 + k, docs[k][1].upper()) for k in range(20)]
    long = {k: text(4000) for k in range(10)}
    docs += [(3000 + k, t) for k, t in long.items()] + [(3100 + k, t.replace(t.split()[2000], "changed", 1)) for k, t in long.items()]
    docs += [(4000 + k, f"{text(30)} {items[k % 5][1]} {text(30)}") for k in range(15)]
    docs += [(5000, None), (5001, ""), (6000, "twice the same row"), (6000, "twice the same row")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(1000 <= i < 2000)) for i, _ in docs if i < 2000]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        seen.append(sorted(r.doc_id for r in docs.collect()))
    clean, single, apart, free = map(set, seen)
    assert not any(1000 <= i < 2000 for i in clean) and len(clean) >= 355
    assert not any(i < 20 for i in single) and {2000 + k for k in range(20)} <= single
    assert (seen[0].count(6000), seen[1].count(6000)) == (2, 1)
    assert 5000 not in single and 5001 in single
    assert {3000 + k for k in range(10)} <= apart and not any(3100 <= i < 3200 for i in apart)
    assert not any(4000 <= i < 5000 for i in free) and free == {i for i in apart if not 4000 <= i < 5000}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == free


def test_run_agrees_with_its_parts(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxic_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    leaked = {r.doc_id for r in decontamination.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    kept = {r.doc_id for r in rows}
    assert not kept & rejected and not kept & leaked
    ends = {}
    for r in rows:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in ends.values():
        assert sum(n for _, n in own) <= 1024 and sorted(own)[0][0] == 0


def test_empty_corpus(spark, folder, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
