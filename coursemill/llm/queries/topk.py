from __future__ import annotations

from pyspark.sql import functions as F

from coursemill.llm.common import table
from coursemill.llm.topk import top_k


def op6_exact_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


QUERIES = {"op6_exact_topk": op6_exact_topk}
SQL = {"op6_exact_topk": """
WITH e AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM e q JOIN e c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 5
"""}
