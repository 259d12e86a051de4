"""Aligned tokens against plain loops over both tokenizers."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillstream.llm import alignment
from tillstream.llm.queries import QUERIES
from tillstream.llm.wordids import byte_level_bytes, piece_bytes

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def ends(ids, tokens):
    at, out = 0, []
    for i in ids:
        at += len(tokens[i])
        out.append(at)
    return out


def plain(texts):
    """The numbers and the digest of each text."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    token_a, token_b = byte_level_bytes(a), piece_bytes(b)
    found, counts = [], Counter()
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(token_a[i] for i in ids_a) != whole or b"".join(token_b[i] for i in ids_b) != whole:
            ids_a, ids_b = [], []
        end_a, end_b = ends(ids_a, token_a), ends(ids_b, token_b)
        by_end = {}
        for j, e in zip(ids_b, end_b, strict=True):
            by_end.setdefault(e, []).append(j)
        links = [(i, j) for i, e in zip(ids_a, end_a, strict=True) for j in by_end.get(e, [])]
        groups, at = [], [0, 0]
        for cut in sorted(set(end_a) & set(end_b)):
            parts = []
            for side, (ids, places) in enumerate(((ids_a, end_a), (ids_b, end_b))):
                begin = at[side]
                while at[side] < len(ids) and places[at[side]] <= cut:
                    at[side] += 1
                parts.append(",".join(map(str, ids[begin : at[side]])))
            groups.append("|".join(parts))
        counts.update(links)
        found.append((len(ids_a), len(ids_b), groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(n, best.get(j, 0))
    return [(x, y, len(g), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if x else "") for x, y, g, links in found]


def odd_rows(seed):
    rng = random.Random(seed)
    parts = ["a", "Bc", " ", " ", "\n", "\t", "é", "12345", "...", " ", "don't", "　", "   ", "日本語", "𝄞", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "ing", " the", " tion"]
    texts = [None, "", " ", "  ", "a", " a", "a ", "a \n b", "ﬁne", "é", "▁", "a▁b", "before ▁ after", "x" * 3000, "\u0000", "﻿a", "word " * 30_000]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(400)]
    return [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (None, "no id"), (7, "again"), (7, "again")]


@pytest.mark.parametrize("head", [1 << 18, 20, 0])
def test_against_plain_loops(spark, monkeypatch, head):
    """With all pairs at hand, with some, with none; blocks and counts of a task handed on early."""
    rows = odd_rows(head)
    monkeypatch.setattr(alignment, "BLOCK", 1000)
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, row int, pair string").repartition(3)
    found = alignment.align(docs, head=head)
    assert found.columns == COLUMNS
    want = [(k, *own) for (k, _), own in zip(rows, plain([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] == 0 for r in want) == 5


def test_no_rows_and_no_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert alignment.align(docs.where("false")).count() == 0
    assert sorted(map(tuple, alignment.align(docs).collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]


def test_query_on_a_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(k, *own) for (k, _), own in zip(rows, plain([t for _, t in rows]), strict=True)]
    found = QUERIES["op13_alignment"](spark, sf)
    assert sorted(map(tuple, found.collect())) == sorted(want)
