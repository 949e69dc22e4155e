"""Mix sources to target weights: hash-random order within each source, prefix sums, exact cuts, whole epochs.

DataFrame functions only. A source may own any share of the rows: its rows are dealt out by ranges of a uniform hash
key, about the square root of all rows to a range, and only one row per range meets in the prefix sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursemill.llm.common import SPACE, WORD, running_sums, saved, shield

#: Columns that ``mix`` adds; columns of these names in the input are replaced.
ADDED = ("size", "source_size", "target", "taken")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words each source shall give, from rows ``_source, source, source_size``.

    Sources in code-point order, null last, take ``weights`` in turn and split ``share`` of all words. No target passes
    ``most`` times the source's size; what is over goes to the others by weight. That is ``least(cap, level * weight)``
    with one level for all, found from prefix sums over the sources in order of cap per weight.
    """
    ranked = running_sums(totals.withColumn("_one", F.lit(1)).withColumn("_last", F.col("source").isNull()),
                          ["_last", "source"], {"_rank": "_one"})
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    capped = (ranked.withColumn("_weight", turn).withColumn("_cap", F.lit(most) * F.col("source_size"))
              .withColumn("_ratio", F.col("_cap") / F.col("_weight")))
    filled = saved(running_sums(capped, ["_ratio", "_source"], {"_cap_before": "_cap", "_weight_before": "_weight"}))
    whole = filled.agg(F.sum("source_size").alias("words"), F.sum("_weight").alias("weights")).first()
    level = (F.lit(share * (whole["words"] or 0)) - F.col("_cap_before")) / (F.lit(whole["weights"]) - F.col("_weight_before"))
    found = (filled.withColumn("_level", level).where("_level <= _ratio")
             .agg(F.min_by("_level", F.struct("_ratio", "_source")).alias("level")).first()["level"])  # one number
    target = F.col("_cap") if found is None else F.least("_cap", F.lit(found) * F.col("_weight"))
    return filled.select("_source", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Input rows with ``size`` (words), ``source_size``, ``target`` (of the source) and ``taken`` (words the mix takes).

    Each source is read in the order of a seeded hash of the id: whole epochs first, then a last one that stops at the
    exact word, so only one document of a source is taken in part. Null text has size 0 and takes nothing; a null
    source is a source of its own; rows that repeat an id are ordered by their text. An empty table stays empty.
    """
    docs, back = shield(docs, [id_col, source_col, text_col], ADDED)
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    ranges = max(1, int(docs.count() ** 0.5))
    keyed = (docs.withColumn("_source", F.coalesce(F.concat(F.lit("s"), source_col), F.lit("n")))
             .withColumn("size", words).withColumn("_text_hash", F.xxhash64(text_col))
             .withColumn("_key", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"))
             .withColumn("_range", F.shiftright(F.shiftright("_key", 29) * F.lit(ranges), 31)))
    sums = saved(keyed.groupBy("_source", "_range").agg(F.sum("size").alias("_words"), F.first(source_col).alias("source")))
    totals = sums.groupBy("_source").agg(F.sum("_words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(totals, weights, share, most)
    by_source = Window.partitionBy("_source")
    offsets = (sums.withColumn("source_size", F.sum("_words").over(by_source))
               .withColumn("_before", F.sum("_words").over(by_source.orderBy("_range")) - F.col("_words"))
               .join(targets, "_source").select("_source", "_range", "source_size", "_before", "target"))
    order = (Window.partitionBy("_source", "_range").orderBy("_key", id_col, "_text_hash")
             .rowsBetween(Window.unboundedPreceding, -1))
    before = F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    budget = F.floor("target")
    epochs = F.coalesce(F.expr("floor(target) div nullif(source_size, 0)"), F.lit(0))
    last = F.greatest(F.lit(0), F.least(F.col("size"), budget - epochs * F.col("source_size") - before))
    return back(keyed.join(offsets, ["_source", "_range"]).withColumn("taken", (epochs * F.col("size") + last).cast("bigint"))
                .drop("_source", "_key", "_range", "_before", "_text_hash"))


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: a row for each whole or partial reading of a document, with the input's columns.

    A document taken in part keeps its first words. Documents of no words are in no reading. ``n_chars``, if there is
    such a column, is the length of the text that is left.
    """
    own = [options.get("id_col", "doc_id"), options.get("source_col", "source"), text_col, "n_chars"]
    columns = docs.columns
    docs, back = shield(docs, own)
    mixed = mix(docs, text_col=text_col, **options).where("taken > 0")
    reads = mixed.withColumn("_copy", F.explode(F.expr("sequence(1, cast(ceil(taken / size) as int))")))
    words = reads.withColumn("_words", F.least("size", F.expr("taken - (_copy - 1) * size")))
    pieces = F.split(F.col(text_col), SPACE, (F.col("_words") + 1 + F.col(text_col).rlike("^" + SPACE).cast("int")).cast("int"))
    kept = F.regexp_replace(F.expr(f"left(`{text_col}`, length(`{text_col}`) - length(_rest))"), SPACE + "$", "")
    cut = (words.withColumn("_rest", F.when(F.col("_words") < F.col("size"), F.element_at(pieces, -1)))
           .withColumn(text_col, F.when(F.col("_rest").isNull(), F.col(text_col)).otherwise(kept)))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return back(cut.select(*docs.columns)).select(*[F.col(f"`{c}`") for c in columns])
