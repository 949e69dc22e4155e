"""Video play time: totals, covered seconds and effective seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coursemill.functions.scalars import interval_text, seconds_between

VIDEO = ["userid", "cwareid", "videoid"]

# fixed values: play-time report -> column it groups by
PLAY_TIMES = {
    "play_time_by_chapter": "chapterid",
    "play_time_by_cware": "cwareid",
    "play_time_by_edutype": "edutypeid",
    "play_time_by_source": "sourceType",
    "play_time_by_subject": "subjectid",
}


def play_time(learn: DataFrame, by: str) -> DataFrame:
    """Seconds played per value of one column."""
    return learn.groupBy(by).agg(F.sum(seconds_between(F.col("ts"), F.col("te"))).alias("totaltime"))


def play_time_all(learn: DataFrame) -> DataFrame:
    """All five play-time reports in one pass: (dimension, id, totaltime)."""
    dims = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("id"))
                     for c in PLAY_TIMES.values()])
    return (learn.select(F.explode(dims).alias("d"), seconds_between(F.col("ts"), F.col("te")).alias("secs"))
            .groupBy("d.dimension", "d.id").agg(F.sum("secs").alias("totaltime")))


def effective_seconds(secs: Column, length: Column, fresh: Column) -> Column:
    """Play time scaled by the share of the range that had not been played before."""
    return F.when(length > 0, F.floor(secs.cast("double") / length * fresh)).otherwise(0).cast("bigint")


def play_order(learn: DataFrame) -> list[Column]:
    """What puts the plays of one range in order: the event id or, in logs without one, times and then content.

    Plays that agree in all columns are equal in that order too, and in all they bring about.
    """
    if "event_id" in learn.columns:
        return [F.col("event_id")]
    return [F.col("ts"), F.col("te"), F.xxhash64(*sorted(learn.columns)).alias("content")]


def folded_ranges(learn: DataFrame) -> DataFrame:
    """One row per video and different range: all its seconds, its first play (``first``), its plays."""
    secs = seconds_between(F.col("ts"), F.col("te"))
    return learn.groupBy(*VIDEO, "ps", "pe").agg(
        F.sum(secs).alias("secs_all"), F.min(F.struct(*play_order(learn), secs.alias("secs"))).alias("first"),
        F.count(F.lit(1)).alias("plays"))


def fresh_of(ranges: DataFrame) -> DataFrame:
    """Add the seconds that each of a video's different ranges is the first to cover, in order of (ps, pe)."""
    earlier = Window.partitionBy(*VIDEO).orderBy("ps", "pe").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("pe").over(earlier), F.col("ps"))
    return ranges.withColumn("fresh", F.greatest(F.col("pe") - F.greatest(F.col("ps"), reached), F.lit(0)))


def fresh_ranges(learn: DataFrame) -> DataFrame:
    """Different ranges of each video with the seconds each one adds.

    Repeats of a range add nothing, so they are folded before the shuffle; a
    video then has at most as many rows as it has different ranges, however
    often it was played. The first play of a range is the one that counts as
    fresh.
    """
    return fresh_of(folded_ranges(learn))


def play_coverage(learn: DataFrame) -> DataFrame:
    """Every play event with the seconds it is the first to cover.

    In logs without an event id equal rows are one row with their number
    (``plays``): of them, the first covers the fresh seconds. Both sides grow
    with the plays, and the optimizer takes parsed lines for much smaller than
    they are, so neither is ever broadcast.
    """
    if "event_id" in learn.columns:
        fresh = fresh_ranges(learn).select("first.event_id", *VIDEO, "ps", "pe", "fresh").alias("f")
        e = learn.select("event_id", *VIDEO, "ps", "pe").alias("e")
        on = [F.col(f"e.{c}") == F.col(f"f.{c}") for c in ["event_id", *VIDEO, "ps", "pe"]]
        return e.join(fresh.hint("merge"), on, "left").select("e.*", F.coalesce("f.fresh", F.lit(0)).alias("fresh"))
    order = ["ts", "te", "content"]
    plays = learn.select("*", play_order(learn)[-1]).groupBy(*learn.columns, "content").agg(F.count(F.lit(1)).alias("plays")).alias("e")
    fresh = fresh_ranges(learn).select(*VIDEO, "ps", "pe", *[f"first.{c}" for c in order], "fresh").alias("f")
    on = [F.col(f"e.{c}").eqNullSafe(F.col(f"f.{c}")) for c in [*VIDEO, "ps", "pe", *order]]
    return plays.join(fresh.hint("merge"), on, "left").select(
        *[F.col(f"e.{c}") for c in learn.columns], "e.plays", F.coalesce("f.fresh", F.lit(0)).alias("fresh"))


def durations_of(ranges: DataFrame) -> DataFrame:
    """Total, effective and completed seconds of each video, from its folded ranges."""
    return fresh_of(ranges).groupBy(*VIDEO).agg(
        F.sum("secs_all").alias("totaltime"),
        F.sum(effective_seconds(F.col("first.secs"), F.col("pe") - F.col("ps"), F.col("fresh"))).alias("effecttime"),
        F.sum("fresh").cast("bigint").alias("completetime"))


def play_durations(learn: DataFrame) -> DataFrame:
    """Total, effective and completed seconds of each video and viewer."""
    return durations_of(folded_ranges(learn))


def merged_ranges(learn: DataFrame) -> DataFrame:
    """Played ranges of each video, overlapping and touching ones joined."""
    longest = learn.groupBy(*VIDEO, "ps").agg(F.max("pe").alias("pe"))
    order = Window.partitionBy(*VIDEO).orderBy("ps")
    reached = F.max("pe").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("ps") > reached), 1).otherwise(0)
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (longest.withColumn("opens", opens).withColumn("island", island)
            .groupBy(*VIDEO, "island").agg(F.min("ps").alias("s"), F.max("pe").alias("e")).drop("island"))


def interval_texts(ranges: DataFrame) -> DataFrame:
    """The merged ranges of each video as ``s-e,s-e``; their number is bounded by the video's length."""
    return (merged_ranges(ranges).groupBy(*VIDEO)
            .agg(interval_text(F.collect_list(F.struct("s", "e"))).alias("play_interval")))


def play_intervals_text(learn: DataFrame) -> DataFrame:
    return interval_texts(learn)
