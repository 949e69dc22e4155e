from __future__ import annotations

from pyspark.sql import functions as F

from coursemill.llm.common import table
from coursemill.llm.merkle import folded, leaf_text, manifest, proof_digest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("_more", F.col("n_chars").cast("decimal(38,0)") + 1)
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    other = F.sha2(leaf_text(["_more" if c == "n_chars" else c for c in COLUMNS]), 256)
    rows = manifest(docs, COLUMNS, "lang", "doc_id", {"tampered": F.when(chosen, other)})
    out = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("witness")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf(n_chars: str) -> str:
    return "sha256(concat(" + ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
        for c in ("doc_id", "source", "lang", n_chars, "text")) + "))"


QUERIES = {"op12_merkle": op12_merkle}
#: One row per leaf and level would be the path of each leaf; the siblings are gathered per leaf instead. The CRC is that of the
#: decimal id's bytes, bit by bit.
SQL = {"op12_merkle": f"""
WITH RECURSIVE
d AS (
    SELECT *, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))),
        lambda acc, x: xor(xor(acc, x) >> 1, CASE WHEN xor(acc, x) & 1 = 1 THEN 3988292384 ELSE 0 END)) AS crc FROM documents),
leaves AS (
    SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
        CASE WHEN xor(crc, 4294967295) % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf('(n_chars + 1)')} END AS tampered FROM d),
p AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n FROM leaves),
tree AS (
    SELECT lang, 0 AS level, pos, leaf AS h, n FROM p
    UNION ALL
    SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM tree WHERE n > 1
    GROUP BY lang, level, pos // 2, n),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS ix, count(*) OVER () AS m FROM tree WHERE n = 1),
top AS (
    SELECT 0 AS level, ix AS pos, subroot AS h, m AS n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
path AS (
    SELECT p.lang, p.pos, p.doc_id, p.leaf, p.tampered, list(t.h ORDER BY t.level) FILTER (t.pos = xor(p.pos >> t.level, 1)) AS sibs,
        list(t.level ORDER BY t.level) FILTER (t.pos = xor(p.pos >> t.level, 1)) AS lv, max(t.level) AS levels
    FROM p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.pos // 2 = p.pos >> (t.level + 1)
    GROUP BY ALL),
above AS (
    SELECT s.lang, s.subroot, s.ix, list(t.h ORDER BY t.level) FILTER (t.pos = xor(s.ix >> t.level, 1)) AS sibs,
        list(t.level ORDER BY t.level) FILTER (t.pos = xor(s.ix >> t.level, 1)) AS lv, max(t.level) AS levels
    FROM subroots s JOIN top t ON t.pos // 2 = s.ix >> (t.level + 1) GROUP BY ALL),
w AS (
    SELECT p.doc_id, p.leaf, p.tampered, a.subroot, (SELECT h FROM top WHERE n = 1) AS root,
        list_transform(range(0, p.levels), lambda l: CASE WHEN list_position(p.lv, l) IS NULL THEN '-'
            WHEN (p.pos >> CAST(l AS INTEGER)) & 1 = 1 THEN 'l' || p.sibs[list_position(p.lv, l)] ELSE 'r' || p.sibs[list_position(p.lv, l)] END)
        || list_transform(range(0, a.levels), lambda l: CASE WHEN list_position(a.lv, l) IS NULL THEN '-'
            WHEN (a.ix >> CAST(l AS INTEGER)) & 1 = 1 THEN 'l' || a.sibs[list_position(a.lv, l)] ELSE 'r' || a.sibs[list_position(a.lv, l)] END) AS steps
    FROM path p JOIN above a ON a.lang IS NOT DISTINCT FROM p.lang),
f AS (
    SELECT *, list_reduce(list_prepend(coalesce(tampered, leaf), steps), lambda acc, s: sha256(
        CASE WHEN s[1] = 'l' THEN s[2:] || acc WHEN s[1] = 'r' THEN acc || s[2:] ELSE acc END)) AS folded_root FROM w)
SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""}
