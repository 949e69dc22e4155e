"""Ranked lexical search over document intervals, bounded by range-maximum tables.

Each row is tokenised once, where it is read; of its words those that some query asks for are kept, with their counts.
From these a task builds an index for chunks of bounded size: per term a posting list in document order with the score
each posting adds, and a sparse table over it that gives the largest of any stretch in constant time.

For a query, an interval of documents can score no more than the sum of its terms' maxima there. Intervals are taken
best first. The one taken is split at the document that holds the largest single maximum; this document is scored
exactly and the parts on its two sides go back with bounds of their own. Once the best bound left is under the k-th best
score found, nothing else can qualify. What a task found in earlier chunks is the threshold of later ones; each task's
best meet in one ranking.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from coursemill.llm.common import saved

#: Words: letters and digits of ASCII and everything beyond it.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Postings of a chunk, characters of the queries that are searched at once, and tasks whose results are ranked together.
CHUNK, AT_ONCE, TASKS = 1 << 20, 4 << 20, 256


def terms_of(text: str | None) -> list[bytes]:
    """Words of a text, only A-Z lowered, as UTF-8."""
    return TERM.findall(text.encode().lower()) if text else []


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def length_norm(n: int, docs: int, total: int) -> int:
    return 100 - 75 + (75 * n * docs) // total


class Queries:
    """Terms of several queries one behind the other, as numbers, with how often each query holds them."""

    def __init__(self, texts: list[str | None]) -> None:
        counts = [Counter(terms_of(t)) for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        self.own = [i for i, c in enumerate(counts) if c]  # places of the queries that have terms
        self.terms = np.array([self.vocabulary[t] for c in counts for t in c], np.int64)
        self.times = np.array([n for c in counts for n in c.values()], np.int64)
        self.length = np.array([len(counts[i]) for i in self.own], np.int64)
        self.first = np.cumsum(self.length) - self.length


class Index:
    """Posting lists of one chunk, one behind the other, and a sparse table of maxima over all of them."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impact: np.ndarray, size: int) -> None:
        """Parallel arrays of postings; ``docs`` are places from 0 to below ``size``."""
        order = np.lexsort((docs, terms))
        self.size = size
        self.docs, self.impact = docs[order], impact[order]
        #: Term and place in one number, ascending: one search finds where a term's postings of an interval begin. One more ends it.
        self.key = np.append(terms[order] * size + self.docs, -1)
        self.sorted = self.key[:-1]
        longest = int(np.bincount(terms).max())
        self.best = np.zeros((longest.bit_length(), len(order)), np.int32)  # of 2 ** level postings the place of the largest
        self.best[0] = np.arange(len(order))
        for level in range(1, len(self.best)):
            half = 1 << (level - 1)
            a, b = self.best[level - 1, :-half], self.best[level - 1, half:]
            self.best[level, :-half] = np.where(self.impact[a] >= self.impact[b], a, b)

    def bounds(self, begin: np.ndarray, end: np.ndarray, times: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[list[int], list[int]]:
        """For each interval, whose stretches begin at ``first``: the sum of their maxima, and the document of the largest."""
        some = end > begin
        level = np.frexp(end - begin)[1] - 1
        level[~some] = 0
        a, b = np.where(some, begin, 0), np.where(some, end - (1 << level), 0)
        a, b = self.best[level, a], self.best[level, b]
        top = np.where(self.impact[a] >= self.impact[b], a, b)
        worth = np.where(some, self.impact[top] * times, 0)
        most = np.maximum.reduceat(worth, first)
        at = np.flatnonzero(worth == most[which])[::-1]
        split = np.zeros(len(first), np.int64)
        split[which[at]] = self.docs[top[at]]
        return np.add.reduceat(worth, first).tolist(), split.tolist()

    def search(self, q: Queries, k: int, least: list[int]) -> tuple[list[list[tuple[int, int]]], int]:
        """Per query the best ``k`` as (score, -place), none under its ``least``, and how many documents were scored.

        All queries take a step at once, each with its own best interval, until its best bound cannot enter its best ``k``.
        """
        best: list[list[tuple[int, int]]] = [[] for _ in q.own]
        waiting: list[list[tuple[int, int, int, int]]] = [[] for _ in q.own]
        looks = 0

        def push(i: int, bound: int, lo: int, hi: int, split: int) -> None:
            if bound >= least[i] and bound > 0 and (len(best[i]) < k or (bound, -lo) > best[i][0]):
                heapq.heappush(waiting[i], (-bound, lo, hi, split))

        which = np.repeat(np.arange(len(q.own)), q.length)
        base = q.terms * self.size
        whole = self.bounds(np.searchsorted(self.sorted, base), np.searchsorted(self.sorted, base + self.size), q.times, q.first, which)
        for i, (bound, split) in enumerate(zip(*whole)):
            push(i, bound, 0, self.size, split)
        active: list[int] = []
        while True:
            now = []
            for i in range(len(q.own)) if not looks else active:
                if waiting[i] and (len(best[i]) < k or (-waiting[i][0][0], -waiting[i][0][1]) > best[i][0]):
                    now.append(i)
            if not now:
                return best, looks
            if now != active:
                active = now
                length = q.length[active]
                first = np.cumsum(length) - length
                which = np.repeat(np.arange(len(active)), length)
                slot = q.first[active][which] + np.arange(len(which)) - first[which]
                base, times = q.terms[slot] * self.size, q.times[slot]
                twice, both = np.concatenate((first, first + len(which))), np.concatenate((which, which + len(active)))
                times_twice = np.concatenate((times, times))
            taken = [heapq.heappop(waiting[i]) for i in active]
            looks += len(taken)
            lo, hi, split = (np.array(c)[which] + base for c in list(zip(*taken))[1:])
            begin, at, end = (np.searchsorted(self.sorted, c) for c in (lo, split, hi))
            hit = self.key[at] == split
            scores = np.add.reduceat(np.where(hit, self.impact[np.minimum(at, len(self.impact) - 1)] * times, 0), first).tolist()
            bound, middle = self.bounds(np.concatenate((begin, at + hit)), np.concatenate((at, end)), times_twice, twice, both)
            for j, i in enumerate(active):
                _, lo_j, hi_j, doc = taken[j]
                if scores[j] >= least[i]:
                    if len(best[i]) < k:
                        heapq.heappush(best[i], (scores[j], -doc))
                    elif (scores[j], -doc) > best[i][0]:
                        heapq.heapreplace(best[i], (scores[j], -doc))
                push(i, bound[j], lo_j, doc, middle[j])
                push(i, bound[j + len(active)], doc + 1, hi_j, middle[j + len(active)])


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``id, n, terms, times``: all words of each document, and which terms of the vocabulary it holds how often."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, held = [], []
                for text in part.column(1).to_pylist():
                    words = terms_of(text)
                    own = Counter(map(number, words))
                    own.pop(None, None)
                    n.append(len(words))
                    held.append(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array([[*h] for h in held], pa.list_(pa.int32())),
                     pa.array([[*h.values()] for h in held], pa.list_(pa.int64()))], ["id", "n", "terms", "times"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(count, f"id {kind}, n bigint, terms array<int>, times array<bigint>")


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows by ascending id (null last), as many as hold ``size`` postings."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held.append(part)
            n += len(part.column(2).flatten())
            if n >= size:
                yield pa.Table.from_batches(held).sort_by("id")
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).sort_by("id")


def _found(counts: DataFrame, queries: Queries, weights: np.ndarray, docs: int, total: int, k: int, size: int) -> DataFrame:
    """``_query, id, score``: the best ``k`` of each task's rows for each query."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple]] = [[] for _ in queries.own]  # best first
        for chunk in _chunks(batches, size):
            ids, terms, times = (chunk[c].combine_chunks() for c in ("id", "terms", "times"))
            held = np.diff(terms.offsets.to_numpy())
            place = np.repeat(np.arange(len(ids)), held)
            if not len(place):
                continue
            # A document's words times all documents may be beyond 64 bits before the division.
            norm = np.array([length_norm(n, docs, total) for n in chunk["n"].to_pylist()], np.int64)[place]
            term, tf = terms.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy()
            index = Index(term, place, weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * norm)), len(ids))
            best, _ = index.search(queries, k, [own[-1][0] if len(own) == k else 1 for own in kept])
            for own, new in zip(kept, best):
                own.extend((score, ids[-place].as_py()) for score, place in new)
                own.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                del own[k:]
        rows = [(queries.own[i], doc, score) for i, own in enumerate(kept) for score, doc in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())],
            ["_query", "id", "score"])

    kind = to_arrow_type(counts.schema["id"].dataType)
    return counts.mapInArrow(search, f"_query int, id {counts.schema['id'].dataType.simpleString()}, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query: of some tasks together first, then of all."""
    best = [F.desc("score"), F.asc_nulls_last("id")]
    part = Window.partitionBy("_query", "_tasks").orderBy(*best)
    some = (found.withColumn("_tasks", F.floor(F.spark_partition_id() / TASKS)).withColumn("rank", F.row_number().over(part))
            .where(F.col("rank") <= k).drop("rank", "_tasks"))
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("_query").orderBy(*best))).where(F.col("rank") <= k)


def ranked_search(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", query_col: str = "item_id", query_text: str = "text", at_once: int = AT_ONCE, chunk: int = CHUNK) -> DataFrame:
    """``query_col, rank, id_col, score``: the ``k`` best documents of each query with a score above 0.

    Ties go to the smaller id, null last. Null and empty texts hold nothing, on either side; a repeated query row is ranked
    on its own, a repeated document row is a document of its own. Empty tables give no rows; other columns are not read.

    Queries are searched in blocks of about ``at_once`` characters, each in one pass over the documents' words: only a block
    reaches the driver, with one count for each of its terms.
    """
    wanted = queries.select(F.col(query_col).alias("_item"), F.col(query_text).alias("_text"))
    size = wanted.agg(F.sum(F.length("_text"))).first()[0] or 0
    blocks = -(-size // at_once)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for b in range(blocks):
        block = wanted if blocks == 1 else wanted.where(F.pmod(F.xxhash64("_item", "_text"), F.lit(blocks)) == b)
        items = block.collect()
        own = Queries([x["_text"] for x in items])
        if not own.own:
            continue
        counts = saved(_counted(rows, own.vocabulary))
        n, total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.array([weight(n, df.get(i, 0)) for i in range(len(own.vocabulary))], np.int64)
        names = spark.createDataFrame([(i, x["_item"]) for i, x in enumerate(items)],
                                      f"_query int, _item {wanted.schema['_item'].dataType.simpleString()}")
        found = _ranked(_found(counts, own, weights, n, total, k, chunk), k).join(names, "_query")
        out = found if out is None else out.unionByName(found)
    if out is None:  # no query has a word
        kinds = {"_item": wanted, "id": rows}
        fields = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c, df in kinds.items())
        out = spark.createDataFrame([], f"{fields}, rank int, score bigint")
    return out.select(F.col("_item").alias(query_col), F.col("rank").cast("int"), F.col("id").alias(id_col), "score")
