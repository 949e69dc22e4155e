from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.mixing import mix


def op7_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op7_mixing": op7_mixing}
SQL = {"op7_mixing": r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('7|' || doc_id::VARCHAR), 1, 15))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2.0::DOUBLE * n AS cap FROM s),
o AS (
    SELECT *, cap / w AS ratio,
        coalesce(sum(cap) OVER f, 0) AS cb, coalesce(sum(w) OVER f, 0) AS wb,
        1.5::DOUBLE * sum(n) OVER () AS words, sum(w) OVER () AS ws
    FROM w WINDOW f AS (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((words - cb) / (ws - wb), ratio) AS level FROM o WHERE (words - cb) / (ws - wb) <= ratio),
t AS (SELECT source, n, coalesce(least(cap, level * w), cap) AS target FROM o, l),
b AS (
    SELECT doc_id, size, n AS source_size, target, floor(target)::BIGINT AS budget,
        coalesce(floor(target)::BIGINT // nullif(n, 0), 0)::BIGINT AS e,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (e * size + greatest(0, least(size, budget - e * source_size - before)))::BIGINT AS taken FROM b
"""}
