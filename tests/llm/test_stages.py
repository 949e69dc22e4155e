"""The mixing stage against plain arithmetic: exact words of each document."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from coursemill.llm import language, near
from coursemill.llm.common import arrow_batches


def plain_mix(rows, weights=(5, 2, 1), share=1.5, most=2.0, seed=7):
    """Words that the mix takes of each ``(id, words, source)``."""
    by = defaultdict(list)
    for i, n, source in rows:
        by[source].append((int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:15], 16), i, n))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for *_, n in by[s]) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    low, high = 0.0, 10.0 * sum(size.values())  # one level for all sources, by halving
    for _ in range(200):
        level = (low + high) / 2
        full = sum(min(most * size[s], level * weight[s]) for s in names)
        low, high = (level, high) if full < share * sum(size.values()) else (low, level)
    taken = Counter()
    for s in names:
        left = int(min(most * size[s], high * weight[s]) + 1e-6)
        while left:
            for _, i, n in sorted(by[s]):
                own = min(n, left)
                taken[i], left = taken[i] + own, left - own
    return {i: n for i, n in taken.items() if n}


def test_mixing_takes_the_exact_words_of_each_document(spark, docs):
    r = random.Random(8)
    rows = [(i, r.randint(1, 30), r.choice(["a", "a", "a", "b", "c", None])) for i in range(150)]
    got = Counter()
    for x in corpus_pipeline.mixing(spark, docs(*[(i, " ".join(f"w{k}" for k in range(n)), "en", s) for i, n, s in rows]), "").collect():
        own = x["text"].split()
        assert own == [f"w{k}" for k in range(len(own))] and x["n_chars"] == len(x["text"])
        got[x["doc_id"]] += len(own)
    assert dict(got) == plain_mix(rows)


FINNISH = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
           "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. ")
POLISH = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i "
          "powinni postępować wobec innych w duchu braterstwa. ")


def test_stages_send_python_few_texts_at_once(spark, docs, monkeypatch):
    """Also where rows are made only when they are written; numbers come in larger batches again."""
    @F.pandas_udf("int")
    def together(key: pd.Series) -> pd.Series:
        return pd.Series([len(key)] * len(key))

    given = docs(*[(i, POLISH * 2 + str(i), "pl", "a") for i in range(1000)]).coalesce(1)
    for stage in (corpus_pipeline.language_id, corpus_pipeline.packing):
        with arrow_batches(spark, 10_000):
            out = stage(spark, given, "").select(together("doc_id").alias("n"))
            assert 0 < out.agg(F.max("n")).first()[0] <= 256
    with arrow_batches(spark, 256):
        key = spark.range(0, 3000, 1, 1).select(F.col("id").alias("node"))
        seen, plain = [], near._kept
        monkeypatch.setattr(near, "_kept", lambda *own: seen.append(key.select(together("node").alias("n")).agg(F.max("n")).first()[0]) or plain(*own))
        corpus_pipeline.near_dedup(spark, given.limit(5), "")
    assert seen == [3000]


def test_language_holds_the_vectors_of_few_trigrams_at_once():
    r = random.Random(3)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1000)) for _ in range(64)]
    owner = np.arange(64) % 3
    language._bundles(texts[:2])
    tracemalloc.start()
    alone, owned = language._bundles(texts), language._bundles(texts, owner, 3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6, f"{most / 1e6:.0f} MB"
    assert (alone[5] == language.trigram_vectors(language.trigrams(texts[5])).sum(axis=0, dtype=np.int64)).all()
    assert all((owned[k] == alone[owner == k].astype(np.float64).sum(axis=0)).all() for k in range(3))


def test_language_bound_rises_smoothly_with_the_length(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cut = [given.where(F.length("text") >= n).select((F.col("doc_id") + n * 10 ** 6).alias("doc_id"), F.substring("text", 1, n).alias("text"),
                                                     F.lit(None).cast("string").alias("lang"), "source", "n_chars") for n in (20, 80, 199, 200, 600)]
    foreign = spark.createDataFrame([(-n - k * 10 ** 4, (t * 9)[:n], None, "s", n) for k, t in enumerate((FINNISH, POLISH)) for n in (20, 120, 199, 600, 1200)],
                                    given.schema)
    docs = given.unionByName(foreign)
    for part in cut:
        docs = docs.unionByName(part)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").select("doc_id").collect()}
    for part in cut:
        ids = [r["doc_id"] for r in part.select("doc_id").collect()]
        assert sum(i in kept for i in ids) > 0.98 * len(ids)
    assert not {-600, -1200, -10199, -10600, -11200, -10120} & kept
    steps = spark.range(0, 3000).select(F.rpad(F.lit("x"), F.col("id").cast("int"), F.lit("x")).alias("t"), (F.col("id") * 0 + 0.15).alias("s"))
    flips = [r[0] for r in steps.select(language.unlike_any(F.col("t"), F.col("s")).cast("int")).collect()]
    assert flips == sorted(flips) and language.MOST * 199 / (199 + language.HALF) - language.MOST * 200 / (200 + language.HALF) > -0.001
