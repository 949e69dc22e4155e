"""Streaming jobs: each turns a stream of rows into a started query.

``trigger`` is that of Spark, e.g. ``EVERY_3_SECONDS``; without it a job takes
what is there and ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from coursemill.functions.cleaning import APP_IDS
from coursemill.functions.scalars import epoch_to_day, now_string
from coursemill.operators.mastery import POINT, answer_counts, mastery_from_counts, questions_from_counts
from coursemill.operators.pages import TRIPLE, page_jump_rate, page_rates, page_transition_count
from coursemill.operators.playback import play_time_all
from coursemill.operators.regions import topk_region, with_province
from coursemill.operators.sinks import replace_table
from coursemill.streaming.sinks import AVAILABLE, append_commits, start
from coursemill.streaming.state import keep_state, same, state_rows, whole_groups

WINDOW, SLIDE = "60 seconds", "6 seconds"  # fixed values
PANES = 10  # slides in a window
LATENESS = "10 minutes"
EVERY_3_SECONDS = {"processingTime": "3 seconds"}


def window_counts(stream: DataFrame, ts: str, key: str, window: str = WINDOW, slide: str = SLIDE,
                  lateness: str = LATENESS) -> DataFrame:
    """Rows per key in sliding windows of event time; on a stream, rows later than ``lateness`` are not counted."""
    return (stream.withWatermark(ts, lateness)
            .groupBy(F.window(ts, window, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("num"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "num"))


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Rows per key since the stream began."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("num"))


def run_window_counts(stream: DataFrame, ts: str, key: str, out: str, checkpoint: str,
                      trigger: dict | None = None, slide: str = SLIDE) -> StreamingQuery:
    """Rows per slide of event time and key in each batch, as commits: however late a row is, it counts.

    There is no state. A row is counted once, not once for each window it lies in; ``read_windows`` makes the windows.
    """
    write = append_commits(out)

    def each(batch: DataFrame, number: int) -> None:
        write(batch.groupBy(F.window(ts, slide)["start"].alias("pane"), key).agg(F.count(F.lit(1)).alias("num")), number)
    return start(stream, checkpoint, each, mode="append", trigger=trigger)


def read_windows(spark: SparkSession, path: str, key: str, slide: str = SLIDE, panes: int = PANES) -> DataFrame:
    """Rows per key in sliding windows of ``panes`` slides, from the commits of ``run_window_counts``; keys are text."""
    stored = spark.read.schema(f"pane timestamp, {key} string, num bigint").parquet(path)
    counts = stored.groupBy("pane", key).agg(F.sum("num").alias("num"))
    step = F.expr(f"INTERVAL {slide}")
    begin = F.explode(F.sequence(F.col("pane") - step * (panes - 1), F.col("pane"), step))
    return (counts.withColumn("window_start", begin).groupBy("window_start", key).agg(F.sum("num").alias("num"))
            .select("window_start", (F.col("window_start") + step * panes).alias("window_end"), key, "num"))


def run_closed_windows(stream: DataFrame, ts: str, key: str, out: str, checkpoint: str,
                       trigger: dict | None = None, **kw) -> StreamingQuery:
    """Counts of each window once it can change no more, as files per day.

    State holds the open windows only and every row is written once, which
    makes this the form for long runs.
    """
    rows = window_counts(stream, ts, key, **kw).withColumn("dt", F.date_format("window_start", "yyyyMMdd"))
    return (rows.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).partitionBy("dt").trigger(**(trigger or AVAILABLE)).start())


def run_running_counts(stream: DataFrame, key: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rows per key since the stream began, in the state store: nothing is written besides."""
    return keep_state(running_counts(stream, key), checkpoint, trigger)


def read_running_counts(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    return state_rows(spark, checkpoint, [key], ["num"])


def run_play_totals(learn: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The five play-time totals as one stateful aggregation over (dimension, id), in the state store."""
    return keep_state(play_time_all(learn), checkpoint, trigger)


def read_play_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    return state_rows(spark, checkpoint, ["dimension", "id"], ["totaltime"])


ANSWER_KEYS = [*POINT, "questionid"]
ANSWER_VALUES = ["qz_sum", "qz_istrue", "createtime"]


def run_point_mastery(spark: SparkSession, answers: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                      at: Column | None = None) -> StreamingQuery:
    """``qz_point_detail`` and ``qz_point_history`` below ``out``, of each batch the points that were answered in it.

    State is one small row per question, where a set of ids per point would be rewritten whole on each answer.
    ``updatetime`` is the time of the batch, or ``at``.
    """
    detail, history = append_commits(f"{out}/qz_point_detail", POINT), append_commits(f"{out}/qz_point_history", POINT)

    def each(batch: DataFrame, number: int) -> None:
        changed = batch.persist()
        before = state_rows(spark, checkpoint, ANSWER_KEYS, ANSWER_VALUES, number - 1) if number else None
        points = whole_groups(changed, before, ANSWER_KEYS, POINT).persist()
        when = now_string(at=at)
        detail(mastery_from_counts(points).withColumn("updatetime", when), number)
        history(questions_from_counts(points).withColumn("updatetime", when), number)
        points.unpersist()
        changed.unpersist()
    return start(answer_counts(answers), checkpoint, each, trigger=trigger)


def run_page_transitions(spark: SparkSession, pages: DataFrame, out: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """``page_jump_rate`` below ``out``: of each batch the transitions it holds and those of pages whose rate has moved."""
    write = append_commits(out, TRIPLE)

    def each(batch: DataFrame, number: int) -> None:
        changed = batch.persist()
        if number:
            before = state_rows(spark, checkpoint, TRIPLE, ["num"], number - 1)
            now = whole_groups(changed, before, TRIPLE, []).persist()
            moved = page_rates(now).exceptAll(page_rates(before)).select("page_id").alias("m")
            after = page_jump_rate(now).alias("a")
            new = changed.select(*TRIPLE).alias("c")
            hit = after.join(new, same("a", "c", TRIPLE), "left_semi")
            drawn = after.join(new, same("a", "c", TRIPLE), "left_anti").join(moved, F.col("a.page_id").cast("int") == F.col("m.page_id"), "left_semi")
            write(hit.unionByName(drawn), number)
            now.unpersist()
        else:
            write(page_jump_rate(changed), number)
        changed.unpersist()
    return start(page_transition_count(pages), checkpoint, each, trigger=trigger)


def run_region_topk(spark: SparkSession, pages: DataFrame, ranges: DataFrame, totals: str, top: str,
                    checkpoint: str, k: int = 3, trigger: dict | None = None) -> StreamingQuery:
    """Visits per province since the stream began, and the top ``k`` replaced on each batch.

    The totals are state. Addresses are looked up row by row and counted inside each task before the shuffle.
    """
    write = append_commits(totals, ["province"])
    counts = with_province(pages.select("ip"), ranges).groupBy("province").agg(F.count(F.lit(1)).alias("num"))

    def each(batch: DataFrame, number: int) -> None:
        changed = batch.persist()
        write(changed, number)
        before = state_rows(spark, checkpoint, ["province"], ["num"], number - 1) if number else None
        replace_table(topk_region(whole_groups(changed, before, ["province"], []), k), top)
        changed.unpersist()
    return start(counts, checkpoint, each, trigger=trigger)


APP_COUNTS = StructType().add("id", "integer").add("servicetype", "string").add("count", "long")


def run_keyed_counts(apps: DataFrame, table: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rows per app (``servicetype``) since the stream began, by its key in a keyed table."""
    ids = F.create_map(*[F.lit(x) for pair in APP_IDS.items() for x in pair])
    counts = apps.groupBy("servicetype").agg(F.count(F.lit(1)).alias("count"))
    write = append_commits(table, ["id"])

    def each(batch: DataFrame, number: int) -> None:
        write(batch.select(F.try_element_at(ids, F.col("servicetype")).alias("id"), "servicetype", "count"), number)
    return start(counts, checkpoint, each, trigger=trigger)


def run_land_raw(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Raw values (columns topic, ts_ms, value) as compressed files below topic and day."""
    rows = stream.select("value", "topic", epoch_to_day(F.col("ts_ms")).alias("dt"))
    return (rows.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).option("compression", "snappy")
            .partitionBy("topic", "dt").trigger(**(trigger or AVAILABLE)).start())
