"""Exact top-k by inner product with no-random-access aggregation over sorted lists.

Each dimension is a list of the candidates' components in order; a query reads lists with a positive weight from the
top and lists with a negative weight from the bottom, one range of all lists after the other. What is read so far gives each
candidate a lower and an upper bound of its score: an unread part lies between the list's reading point and its end. A
query stops when the candidates whose upper bound reaches its k-th best lower bound are few; their scores are then
resolved. A query whose outsiders can qualify to the end has read all lists, and its lower bounds are the scores.

Candidates are dealt into shards and queries into blocks of fixed size; each pair of shard and block is one task, in
which the bounds of all queries that still read are two matrix products per range. Only k rows per query and shard leave a
task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard and of a block of queries: memory of a task, whatever the size of the table.
SHARD, BLOCK = 4096, 1024
#: A query stops reading at this many times k candidates.
FEW = 4


def _kind(q: np.ndarray, x: np.ndarray):
    """The fastest number type in which no sum of products is rounded."""
    most = max(1, 2 * q.shape[1]) * (int(np.abs(q).max(initial=0)) + 1) * (int(np.abs(x).max(initial=0)) + 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def nra(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """``(query row, candidate row, score)``: for each query its k best candidates with another id, and all ties of the k-th.

    Second: of each query, the share of the lists that it read.
    """
    kind, n = _kind(q, x), len(x)
    lists = np.sort(x, axis=0)
    low, high = lists[:1], lists[-1:]
    both = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(kind)
    rows, reading, read = np.arange(n), np.arange(len(q)), np.ones(len(q))
    worst = np.iinfo(np.int64).min if kind is object else -np.inf
    out: list[tuple[int, int, int]] = []

    def scores(up: np.ndarray, down: np.ndarray) -> np.ndarray:
        got = both[reading] @ np.concatenate([up, down], axis=1).astype(kind).T
        got[q_ids[reading][:, None] == x_ids[rows][None, :]] = worst
        return got

    def kth(values: np.ndarray) -> np.ndarray:
        last = max(0, values.shape[1] - k)
        return (np.sort(values, axis=1) if kind is object else np.partition(values, last, axis=1))[:, last]

    depth = min(n, max(k + 1, n // 16))
    while len(reading):
        top, bottom, own = lists[n - depth][None, :], lists[depth - 1][None, :], x[rows]
        read_up, read_down = own >= top, own <= bottom  # a run of equal values is read as one
        lower = scores(np.where(read_up, own, low), np.where(read_down, own, high))
        least = kth(lower)
        if depth == n:
            for i, values, bound in zip(reading.tolist(), lower, least):
                at = np.flatnonzero((values >= bound) & (values != worst))
                out.extend((i, int(rows[j]), int(values[j])) for j in at.tolist())
            break
        able = scores(np.where(read_up, own, top), np.where(read_down, own, bottom)) >= least[:, None]
        done = able.sum(axis=1) <= FEW * k
        for j in np.flatnonzero(done).tolist():
            i, some = int(reading[j]), rows[able[j]]
            some = some[x_ids[some] != q_ids[i]]
            exact = x[some].astype(object if kind is object else np.int64) @ q[i].astype(object if kind is object else np.int64)
            if len(some):
                bound = sorted(exact.tolist(), reverse=True)[min(k, len(some)) - 1]
                out.extend((i, int(r), int(v)) for r, v in zip(some.tolist(), exact.tolist()) if v >= bound)
            read[i] = depth / n
        able, reading = able[~done], reading[~done]
        rows = rows[able.any(axis=0)]
        depth = min(n, depth * 2)
    return out, read


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the largest inner product for each query row, its own id left out.

    Components become floor(scale * x). Rows without an id or vector, or with a null or non-finite component, take no part;
    vectors meet only vectors of their length. Ties go to the smaller id. Rows that repeat an id are candidates each, and
    a query once. Fewer than k candidates: all. An empty table gives no rows.
    """
    valid = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & valid).select(
        F.col(id_col).alias("id"), is_query.alias("asks"),
        F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale)).alias("v")).withColumn("dim", F.size("v"))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    shards, blocks = max(1, math.ceil(sizes["n"] / SHARD)), max(1, math.ceil(sizes["q"] / BLOCK))
    deal = lambda n, c: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int").alias(c)
    each = lambda n, c: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(c)
    asked = rows.where("asks").dropDuplicates(["id", "v"]).select("dim", each(shards, "shard"), deal(blocks, "block"), "id", "v")
    given = rows.select("dim", deal(shards, "shard"), each(blocks, "block"), "id", "v")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable").reset_index(drop=True)
            q, x = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
            hits, _ = nra(q, left["id"].to_numpy(), x, right["id"].to_numpy(), k)
            frame = pd.DataFrame(hits, columns=["q", "x", "score"])
            frame = frame.sort_values(["q", "score", "x"], ascending=[True, False, True], kind="stable").groupby("q").head(k)
            ids, vecs = left["id"].to_numpy(), left["mark"].to_numpy()
            found = [(ids[i], vecs[i], right["id"].iloc[j], s) for i, j, s in frame.itertuples(index=False)]
        return pd.DataFrame(found, columns=["query_id", "mark", "vec_id", "score"])

    kind = dict(rows.dtypes)["id"]
    marked = asked.withColumn("mark", F.xxhash64("v"))
    cells = ["dim", "shard", "block"]
    near = (marked.groupBy(*cells).cogroup(given.groupBy(*cells))
            .applyInPandas(best, f"query_id {kind}, mark bigint, vec_id {kind}, score bigint"))
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
