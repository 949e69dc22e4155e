"""Ranked search against scores of all documents."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from coursemill.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, queries, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    n = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in queries:
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n // total if total else 0
            score = sum(lexical.weight(n, df[t]) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(n, seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "é", "x9", "语言"]
    rows = [(i, " ".join(r.choice(vocabulary[:int(10 ** r.uniform(.5, 2.48))]) for _ in range(r.randint(0, 80)))) for i in range(n)]
    rows += [(n + i, rows[i % 7][1].upper()) for i in range(40)]  # copies: equal scores
    queries = [(q, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 25)))) for q in range(30)]
    return rows, queries


@pytest.mark.parametrize("k, at_once, chunk", [(10, 1 << 20, 1 << 20), (3, 200, 300), (1, 1 << 20, 50)])
def test_best_documents_equal_brute_force(spark, k, at_once, chunk):
    rows, queries = corpus(300)
    got = lexical.ranked_search(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3),
                                spark.createDataFrame(queries, "item_id bigint, text string"), k, at_once=at_once, chunk=chunk)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, queries, k)


def test_hard_rows_repeated_queries_and_empty_tables(spark, hard):
    queries = spark.createDataFrame([(1, "line one two"), (1, "text"), (None, "words words"), (2, None), (3, ""), (4, "... !")], "item_id bigint, text string")
    got = lexical.ranked_search(spark, hard, queries).collect()
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, [(r["item_id"], r["text"]) for r in queries.collect()])
    for docs, wanted in ((hard.limit(0), queries), (hard, queries.limit(0)), (hard, queries.where("item_id > 1"))):
        empty = lexical.ranked_search(spark, docs, wanted)
        assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_few_documents_are_scored_where_impacts_are_skewed():
    r = random.Random(1)
    size = 5000
    postings = [(t, d, r.randint(1, 50) if d % 997 else 10 ** 6 + d) for t in range(8) for d in range(size) if r.random() < .5]
    terms, docs, impact = (np.array(c, np.int64) for c in zip(*postings))
    queries = lexical.Queries(["0 1 2 3 4 5 6 7"])
    best, looks = lexical.Index(terms, docs, impact, size).search(queries, 3, [1])
    scores = np.bincount(docs, impact, size).astype(int)
    assert sorted(best[0], reverse=True) == sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:3]
    assert looks < size / 100


def test_documents_of_equal_score_are_not_all_scored():
    terms, docs = np.zeros(3000, np.int64), np.arange(3000)
    best, looks = lexical.Index(terms, docs, np.full(3000, 7), 3000).search(lexical.Queries(["a"]), 4, [1])
    assert sorted(best[0], reverse=True) == [(7, 0), (7, -1), (7, -2), (7, -3)] and looks < 40
