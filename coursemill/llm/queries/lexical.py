from __future__ import annotations

from coursemill.llm.common import table
from coursemill.llm.lexical import ranked_search


def op11_lexical(spark, sf_dir):
    return ranked_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
QUERIES = {"op11_lexical": op11_lexical}
SQL = {"op11_lexical": f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, text FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
dt AS (SELECT k, {TERMS} AS term FROM d),
qt AS (SELECT i, {TERMS} AS term FROM q),
tf AS (SELECT k, term, count(*) AS tf FROM dt GROUP BY k, term),
n AS (SELECT k, sum(tf)::BIGINT AS n FROM tf GROUP BY k),
c AS (SELECT count(*) AS N, sum(n)::BIGINT AS L FROM n),
w AS (SELECT term, floor(1000 * ln((2 * (SELECT N FROM c) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf GROUP BY term),
m AS (SELECT k, 100 - 75 + ((75 * n.n * c.N) // c.L) AS m FROM n, c),
s AS (
    SELECT i, k, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM qt JOIN tf USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY i, k),
r AS (
    SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM s JOIN d USING (k) JOIN q USING (i) WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""}
