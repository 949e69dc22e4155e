from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.lines import dedup_lines


def op5_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


QUERIES = {"op5_line_dedup": op5_line_dedup}
SQL = {"op5_line_dedup": r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents),
w AS (SELECT doc_id, p, line, lead(line, 1) OVER f AS b, lead(line, 2) OVER f AS c FROM l WINDOW f AS (PARTITION BY doc_id ORDER BY p)),
v AS (SELECT * FROM w WHERE c IS NOT NULL AND regexp_matches(line || b || c, '[^\x20\x09-\x0D]')),
o AS (SELECT doc_id, p, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, p) AS r FROM v),
cut AS (SELECT DISTINCT doc_id, p + k AS p FROM o, range(3) g(k) WHERE r > 1)
SELECT l.doc_id, count(*) AS n_lines, count(cut.p) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY l.p) FILTER (WHERE cut.p IS NULL), '') AS text
FROM l LEFT JOIN cut USING (doc_id, p) GROUP BY l.doc_id
"""}
