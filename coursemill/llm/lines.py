"""Line dedup: windows of three consecutive lines; later occurrences of a repeated window are cut out.

DataFrame functions only. Window hashes are counted with map-side aggregation, so a passage that stands in a third of
all documents costs one row per task; texts meet the positions to cut by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import let, shield

ADDED = ("n_lines", "n_removed")


def line_windows(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _text, _pos, _h1, _h2``: a row for each window of ``width`` lines that are not all blank; 128 bits of hash."""
    # Java's \s and trim differ on rare characters; a line is blank if it has no word.
    def window(lines, start):
        own = [F.get(lines, start + k) for k in range(width)]
        return F.struct(start.alias("_pos"), F.xxhash64(F.lit(1), *own).alias("_h1"), F.xxhash64(F.lit(2), *own).alias("_h2"),
                        F.concat(*own).rlike(r"[^\x20\x09-\x0D]").alias("_words"))

    starts = lambda lines: F.when(F.size(lines) >= width, F.sequence(F.lit(0), F.size(lines) - width))
    windows = let(F.split(F.col(text_col), "\n"), lambda lines: F.transform(starts(lines), lambda i: window(lines, i)))
    return (docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"), F.inline(windows))
            .where("_words").drop("_words"))


def dedup_lines(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input rows with the text left after the cut, ``n_lines`` (before) and ``n_removed``.

    A window occurs first at the smallest (id, position), null ids first; every line that a later occurrence covers
    goes, overlaps merged, also where a text repeats itself. Lines are compared as they are; all-blank windows don't
    count. Texts under ``width`` lines have no window and stay, as do null (0 lines) and empty texts. Rows equal in id
    and text are one document and are cut alike.
    """
    docs, back = shield(docs, [id_col, text_col], ADDED)
    windows = line_windows(docs, width, id_col, text_col)
    place = F.struct("_id", "_text", "_pos")
    repeated = windows.groupBy("_h1", "_h2").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    later = windows.join(repeated.drop("_n"), ["_h1", "_h2"]).where(place != F.col("_first"))
    cuts = (later.groupBy("_id", "_text").agg(F.sort_array(F.collect_set("_pos")).alias("_at"))
            .withColumn("_from", F.expr(f"filter(_at, (x, i) -> i = 0 or x - get(_at, i - 1) > {width})"))
            .withColumn("_to", F.expr(f"transform(filter(_at, (x, i) -> i = size(_at) - 1 or get(_at, i + 1) - x > {width}), x -> x + {width})"))
            .drop("_at"))
    rows = docs.withColumn("_row", F.xxhash64(text_col))
    joined = rows.join(cuts, F.col(id_col).eqNullSafe(F.col("_id")) & F.col("_row").eqNullSafe(F.col("_text")), "left").drop("_id", "_text", "_row")
    kept = let(F.split(F.col(text_col), "\n"), lambda lines: F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("_from")),
        lambda k: let(F.coalesce(F.get("_to", k - 1), F.lit(0)), lambda a: F.slice(
            lines, a + 1, F.coalesce(F.get("_from", k), F.size(lines)) - a)))))
    removed = F.expr("aggregate(zip_with(_from, _to, (a, b) -> b - a), 0, (s, x) -> s + x)")
    out = (joined.withColumn("n_lines", F.coalesce(F.size(F.split(F.col(text_col), "\n")), F.lit(0)).cast("bigint"))
           .withColumn("n_removed", F.coalesce(removed, F.lit(0)).cast("bigint"))
           .withColumn(text_col, F.when(F.col("_from").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))))
    return back(out.drop("_from", "_to"))
