"""Report metrics over the wide tables.

Every grouped metric takes ``dt``: a day, or None for each day on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coursemill.functions.scalars import PASS_MARK, safe_rate, score_band
from coursemill.operators.joins import _present
from coursemill.sources.tables import partition_filter

# --- members -------------------------------------------------------------------

# fixed values: member report -> column it counts by
MEMBER_COUNTS = {
    "count_by_appregurl": "appregurl",
    "count_by_sitename": "sitename",
    "count_by_regsource": "regsourcename",
    "count_by_adname": "adname",
    "count_by_memberlevel": "memberlevel",
    "count_by_viplevel": "vip_level",
}
# fixed values: columns of the top payers table
TOP_PAYERS = ("uid memberlevel register appregurl regsourcename adname sitename vip_level paymoney rownum "
              "dt dn").split()


def member_count(wide: DataFrame, by: str, dt: str | None = None) -> DataFrame:
    """Members per value of one column, site and day; null is a value of its own."""
    return (partition_filter(wide, dt).groupBy(by, "dn", "dt")
            .agg(F.count(F.lit(1)).alias("num")).select(by, "num", "dt", "dn"))


def member_counts(wide: DataFrame, dt: str | None = None) -> DataFrame:
    """All member counts out of one pass: (report, value, num, dt, dn)."""
    by = list(MEMBER_COUNTS.values())
    rows = partition_filter(wide, dt)
    sets = rows.groupingSets([[F.col(c), F.col("dn"), F.col("dt")] for c in by], *[F.col(c) for c in [*by, "dn", "dt"]])
    counts = sets.agg(*[F.grouping(c).alias(f"_not_{c}") for c in by], F.count(F.lit(1)).alias("num"))
    report, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, c in MEMBER_COUNTS.items():
        report = F.when(F.col(f"_not_{c}") == 0, F.lit(name)).otherwise(report)
        value = F.when(F.col(f"_not_{c}") == 0, F.col(c).cast("string")).otherwise(value)
    return counts.select(report.alias("report"), value.alias("value"), "num", "dt", "dn")


def counts_of(counts: DataFrame, report: str) -> DataFrame:
    """One report of ``member_counts``, as ``member_count`` gives it."""
    return counts.where(F.col("report") == report).select(F.col("value").alias(MEMBER_COUNTS[report]), "num", "dt", "dn")


def top3_payers(wide: DataFrame, dt: str | None = None, k: int = 3) -> DataFrame:
    """The ``k`` best payers of each site and level; ties go to the smaller uid.

    There are only a few (site, level) groups and each is huge. Spark turns the
    filter on ``row_number`` into a limit per group ahead of the shuffle, so
    that each task sends at most ``k`` rows of a group.
    """
    rank = Window.partitionBy("dt", "dn", "memberlevel").orderBy(F.desc("paymoney"), "uid")
    top = (partition_filter(wide, dt).withColumn("rownum", F.row_number().over(rank))
           .where(F.col("rownum") <= k))
    return _present(top, TOP_PAYERS).orderBy("memberlevel", "rownum")


# --- papers --------------------------------------------------------------------

PAPER = ["paperviewid", "paperviewname", "dt", "dn"]
# fixed values: columns of the ranked answers tables
RANKED = ("userid paperviewid paperviewname chaptername pointname sitecoursename coursename majorname shortname "
          "papername score rk dt dn").split()


def paper_summary(detail: DataFrame, dt: str | None = None) -> DataFrame:
    """Average, extremes, failed and passed answers of each paper: one pass for three reports."""
    score = F.col("score")
    return (partition_filter(detail, dt).groupBy(*PAPER)
            .agg(F.avg("score").alias("_avgscore"), F.avg("spendtime").alias("_avgspendtime"),
                 F.max("score").alias("_max"), F.min("score").alias("_min"),
                 F.count_if(score.between(0, PASS_MARK)).alias("unpasscount"),
                 F.count_if(score > PASS_MARK).alias("_pass")))


def avg_of(summary: DataFrame, time_type: str = "decimal(10,1)") -> DataFrame:
    return summary.select("paperviewid", "paperviewname", F.col("_avgscore").cast("decimal(4,1)").alias("avgscore"),
                          F.col("_avgspendtime").cast(time_type).alias("avgspendtime"), "dt", "dn")


def max_min_of(summary: DataFrame) -> DataFrame:
    return summary.select("paperviewid", "paperviewname", F.col("_max").cast("decimal(4,1)").alias("maxscore"),
                          F.col("_min").cast("decimal(4,1)").alias("minscore"), "dt", "dn")


def pass_rate_of(summary: DataFrame) -> DataFrame:
    """Papers without a failed or a passed answer do not appear; passes are counted per paper whatever its name."""
    passed = F.sum("_pass").over(Window.partitionBy("paperviewid", "dt", "dn"))
    return (summary.withColumn("passcount", passed)
            .where((F.col("unpasscount") > 0) & (F.col("passcount") > 0))
            .select("paperviewid", "paperviewname", "unpasscount", "passcount",
                    safe_rate(F.col("passcount"), F.col("unpasscount")).alias("rate"), "dt", "dn"))


def paper_avg(detail: DataFrame, dt: str | None = None, time_type: str = "decimal(10,1)") -> DataFrame:
    """Average score and time per paper."""
    return avg_of(paper_summary(detail, dt), time_type)


def paper_max_min(detail: DataFrame, dt: str | None = None) -> DataFrame:
    """Best and worst score per paper."""
    return max_min_of(paper_summary(detail, dt))


def ranked_answers(detail: DataFrame, dt: str | None, k: int, best: bool) -> DataFrame:
    """All rows whose score is among the ``k`` best (or worst) different scores of their paper.

    Ranking the rows themselves would pull every row of a paper into one task.
    A dense rank depends on the different scores only, and a paper has few of
    those: they are reduced before the shuffle, ranked, and joined back.
    """
    rows = partition_filter(detail, dt)
    scores = rows.select("paperviewid", "dt", "score").distinct()
    order = F.desc("score") if best else F.asc("score")
    kept = (scores.withColumn("rk", F.dense_rank().over(Window.partitionBy("dt", "paperviewid").orderBy(order)))
            .where(F.col("rk") <= k).alias("s"))
    d = rows.alias("d")
    on = ((F.col("d.paperviewid") == F.col("s.paperviewid")) & (F.col("d.dt") == F.col("s.dt"))
          & F.col("d.score").eqNullSafe(F.col("s.score")))
    return _present(d.join(kept, on, "inner").select("d.*", "s.rk"), RANKED)


def paper_top3(detail: DataFrame, dt: str | None = None, k: int = 3) -> DataFrame:
    return ranked_answers(detail, dt, k, best=True)


def paper_low3(detail: DataFrame, dt: str | None = None, k: int = 3) -> DataFrame:
    return ranked_answers(detail, dt, k, best=False)


def filter_after_project(df: DataFrame, columns: list[str], cond: Column) -> DataFrame:
    """Rows that meet a condition on a column the result does not show."""
    return df.where(cond).select(*columns)


BAND = [*PAPER, "score_segment"]
SLOTS = 1 << 16  # counts of bands that a task holds at once


def score_segment_users(detail: DataFrame, dt: str | None = None, ids_per_row: int = 100_000) -> DataFrame:
    """User ids of each paper and score band as comma text, in ascending order, repeats kept.

    A band may hold any number of users, so its text is cut into rows of at
    most ``ids_per_row`` ids, numbered by ``part``; a band that fits is one row
    with part 0, as nearly all do. User ids are whole numbers. Rows come in no
    particular order.
    """
    rows = (partition_filter(detail, dt).where(F.col("userid").isNotNull())
            .select(*PAPER, score_band(F.col("score")).alias("score_segment"), "userid"))
    long = _long_bands(rows, ids_per_row)
    marked = _same_band(rows, F.broadcast(long.withColumn("_long", F.lit(True))), "left").select(*[F.col(f"a.{c}") for c in rows.columns], "_long")
    # Rows of short bands are shuffled once, as they are: nearly all users differ, so folding them first would save nothing.
    short = (marked.where(F.col("_long").isNull()).repartition(*BAND).groupBy(*BAND)
             .agg(F.array_sort(F.collect_list("userid")).alias("ids"))
             .select(*BAND, F.lit(0).cast("bigint").alias("part"), F.concat_ws(",", F.col("ids").cast("array<string>")).alias("userids")))
    many = marked.where("_long").groupBy(*BAND, "userid").agg(F.count(F.lit(1)).alias("n"))
    ids = F.array_sort(F.collect_list(F.struct("userid", "copies")))
    text = F.concat_ws(",", F.flatten(F.transform(
        ids, lambda u: F.array_repeat(u["userid"].cast("string"), u["copies"]))))
    cut = _numbered(many, ids_per_row).groupBy(*BAND, "part").agg(text.alias("userids"))
    return short.unionByName(cut).select("paperviewid", "paperviewname", "score_segment", "part", "userids", "dt", "dn")


def _long_bands(rows: DataFrame, ids_per_row: int, slots: int = SLOTS) -> DataFrame:
    """Bands of more than ``ids_per_row`` rows.

    Bands are first counted by a slot of their hash, inside each task: only bands of slots that full are counted one by
    one. At most one band, and one slot, in ``ids_per_row`` rows is that full.
    """
    own = rows.select(*BAND, F.pmod(F.xxhash64(*BAND), F.lit(slots)).alias("slot"))
    full = own.groupBy("slot").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ids_per_row).select("slot")
    return (own.join(F.broadcast(full), "slot", "left_semi").groupBy(*BAND).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > ids_per_row).select(*BAND))


def _same_band(a: DataFrame, b: DataFrame, how: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Join of frames ``a`` and ``b`` on the band, nulls matching nulls, and on ``more`` columns."""
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in BAND] + [F.col(f"a.{c}") == F.col(f"b.{c}") for c in more]
    return a.alias("a").join(b.alias("b"), on, how)


def _numbered(rows: DataFrame, ids_per_row: int) -> DataFrame:
    """Cut the (band, userid, n) rows of long bands into numbered parts of ``ids_per_row`` ids.

    Positions are found without gathering a band in one task: ids are counted
    per block of neighbouring ids, blocks get their offset from a running sum,
    and only then are ids numbered inside their block. An id that is repeated
    past the end of a part goes on in the next.
    """
    span = max(1, ids_per_row // 10)
    rows = rows.withColumn("block", F.floor(F.col("userid") / span))
    blocks = rows.groupBy(*BAND, "block").agg(F.sum("n").alias("block_n")).withColumn("area", F.floor(F.col("block") / span))
    # Blocks are summed up inside areas and areas inside the band, so that no task holds all blocks of a band.
    areas = blocks.groupBy(*BAND, "area").agg(F.sum("block_n").alias("area_n"))
    earlier = Window.partitionBy(*BAND).orderBy("area").rowsBetween(Window.unboundedPreceding, -1)
    areas = areas.select(*BAND, "area", F.coalesce(F.sum("area_n").over(earlier), F.lit(0)).alias("area_offset"))
    before = Window.partitionBy(*BAND, "area").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("block_n").over(before), F.lit(0)))
    blocks = _same_band(blocks, areas, "inner", ("area",)).select(
        *[F.col(f"a.{c}") for c in BAND], "a.block", (F.col("b.area_offset") + F.col("a.inside")).alias("offset"))

    upto = Window.partitionBy(*BAND, "block").orderBy("userid").rowsBetween(Window.unboundedPreceding, 0)
    size = F.lit(ids_per_row)
    placed = (_same_band(rows, blocks, "inner", ("block",)).select("a.*", "b.offset")
              .withColumn("stop", F.col("offset") + F.sum("n").over(upto))
              .withColumn("start", F.col("stop") - F.col("n")))
    first, last = F.floor(F.col("start") / size), F.floor((F.col("stop") - 1) / size)
    copies = F.least("stop", (F.col("part") + 1) * size) - F.greatest("start", F.col("part") * size)
    return (placed.withColumn("part", F.explode(F.sequence(first, last)))
            .select(*BAND, "userid", "part", copies.cast("int").alias("copies")))


def paper_pass_rate(detail: DataFrame, dt: str | None = None) -> DataFrame:
    """Failed (0 to 60) and passed (above 60) answers per paper and the pass rate."""
    return pass_rate_of(paper_summary(detail, dt))


def question_error_rate(detail: DataFrame, dt: str | None = None, limit: int | None = None) -> DataFrame:
    """Wrong (0) and right (1) answers per question and the error rate.

    Questions without one of the two do not appear; ``limit`` gives the top n, most wrong first.
    """
    answer = F.col("user_question_answer").cast("string")
    counts = (partition_filter(detail, dt).groupBy("questionid", "dt", "dn")
              .agg(F.count_if(answer == "0").alias("errcount"), F.count_if(answer == "1").alias("rightcount"))
              .where((F.col("errcount") > 0) & (F.col("rightcount") > 0))
              .select("questionid", "errcount", "rightcount",
                      safe_rate(F.col("errcount"), F.col("rightcount")).alias("rate"), "dt", "dn"))
    return counts if limit is None else counts.orderBy(F.desc("errcount"), "questionid", "dt", "dn").limit(limit)


def rate_pair_join(a: DataFrame, b: DataFrame, keys: list[str], part: str, rest: str) -> DataFrame:
    """Two counts of one table side by side, with the share of the first."""
    return a.join(b, keys, "inner").withColumn("rate", safe_rate(F.col(part), F.col(rest)))


# --- counting under skew ---------------------------------------------------------

def salted_count(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """Count per key in two stages, each key first spread over ``n`` sub-keys.

    Plain ``groupBy`` already combines inside each task, which is enough on a
    bounded frame; two stages also keep the second shuffle of a hot key apart.
    A sub-key is the task that read a row: the same rows on a retry, and equal
    rows are apart as far as they were read by several tasks.
    """
    salt = F.spark_partition_id() % n
    return (df.groupBy(key, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(key).agg(F.sum("_n").alias("num")))
