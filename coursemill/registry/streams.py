"""Streaming jobs: the events table as a stream, run until it is used up, and the result read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from coursemill.operators import mastery as K
from coursemill.operators import pages as P
from coursemill.operators.playback import PLAY_TIMES
from coursemill.registry import inputs as I
from coursemill.registry.pages import FUNNEL_SQL, REGION_SQL
from coursemill.registry.playback import INTERVALS_SQL, LOG_DURATIONS_SQL, MASTERY_SQL
from coursemill.session import scratch_dir
from coursemill.streaming import jobs, learn
from coursemill.streaming.sinks import read_state


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_running_count(spark: SparkSession, sf: str) -> DataFrame:
    checkpoint = scratch_dir(spark, "running")
    _finish(jobs.run_running_counts(I.event_stream(spark, sf), "event_type", checkpoint))
    return jobs.read_running_counts(spark, checkpoint, "event_type")


def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_sliding_window(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "windows")
    _finish(jobs.run_window_counts(_timed(I.event_stream(spark, sf)), "ts", "event_type", f"{base}/out", f"{base}/cp"))
    rows = jobs.read_windows(spark, f"{base}/out", "event_type")
    at = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")]
    return rows.select(*at, "event_type", "num")


def stream_play_totals(spark: SparkSession, sf: str) -> DataFrame:
    checkpoint = scratch_dir(spark, "totals")
    _finish(jobs.run_play_totals(I.learn(I.event_stream(spark, sf)), checkpoint))
    return jobs.read_play_totals(spark, checkpoint)


def _learned(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    """Tables that the learning job writes, out of plays without an event id, as the logs have them."""
    base = scratch_dir(spark, "learn")
    plays = I.learn(I.event_stream(spark, sf)).drop("event_id")
    _finish(learn.run_learn(spark, plays, f"{base}/out", f"{base}/cp"))
    return [read_state(spark, f"{base}/out/{n}", learn.TABLES[n][0], learn.table_schema(plays, n)) for n in names]


def stream_play_coverage(spark: SparkSession, sf: str) -> DataFrame:
    ranges, seconds = _learned(spark, sf, "video_interval", "video_learn_detail")
    return ranges.join(seconds, learn.VIDEO)


def stream_learn_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _learned(spark, sf, "play_time")[0]


def _mastered(spark: SparkSession, sf: str, name: str, schema: str) -> DataFrame:
    base = scratch_dir(spark, "mastery")
    at = F.lit("2030-01-01 00:00:00").cast("timestamp")
    _finish(jobs.run_point_mastery(spark, I.answers(I.event_stream(spark, sf)), base, f"{base}/cp", at=at))
    full = StructType.fromDDL(f"userid bigint, courseid bigint, pointid bigint, {schema}, createtime string, updatetime string")
    return read_state(spark, f"{base}/{name}", K.POINT, full)


def stream_point_mastery(spark: SparkSession, sf: str) -> DataFrame:
    return _mastered(spark, sf, "qz_point_detail", "qz_sum bigint, qz_count bigint, qz_istrue bigint, correct_rate double, mastery_rate double")


def stream_point_questions(spark: SparkSession, sf: str) -> DataFrame:
    return _mastered(spark, sf, "qz_point_history", "questionids string")


def _transitions(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "funnel")
    _finish(jobs.run_page_transitions(spark, I.pages(I.event_stream(spark, sf)), f"{base}/out", f"{base}/cp"))
    return read_state(spark, f"{base}/out", P.TRIPLE, StructType.fromDDL(
        "last_page_id string, page_id string, next_page_id string, num bigint, jump_rate string"))


def stream_page_jump_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _transitions(spark, sf)


def stream_page_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return P.page_funnel(P.page_visit_total(_transitions(spark, sf)))


def stream_region_topk(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "regions")
    _finish(jobs.run_region_topk(spark, I.pages(I.event_stream(spark, sf)), I.ranges(spark, sf), f"{base}/totals",
                                 f"{base}/top", f"{base}/cp"))
    return spark.read.parquet(f"{base}/top")


def stream_keyed_counts(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "keyed-counts")
    kind = F.col("event_type")
    app = F.when(kind == "view", "PC").when(kind == "click", "APP").otherwise("Other")
    _finish(jobs.run_keyed_counts(I.event_stream(spark, sf).select(app.alias("servicetype")), f"{base}/table", f"{base}/cp"))
    return read_state(spark, f"{base}/table", ["id"], jobs.APP_COUNTS)


def stream_land_raw(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "land")
    raw = I.event_stream(spark, sf).select(
        F.concat_ws("|", I.text("event_id"), "props").alias("value"), F.col("event_type").alias("topic"),
        I.millis().alias("ts_ms"))
    _finish(jobs.run_land_raw(raw, f"{base}/out", f"{base}/cp"))
    return spark.read.schema("value string, topic string, dt string").parquet(f"{base}/out")


QUERIES = {f.__name__: f for f in (
    stream_running_count, stream_sliding_window, stream_play_totals, stream_play_coverage, stream_learn_totals,
    stream_point_mastery, stream_point_questions, stream_page_jump_rate, stream_page_funnel, stream_region_topk, stream_keyed_counts, stream_land_raw)}

_TOTALS = " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, CAST(\"{c}\" AS VARCHAR) AS id, CAST(sum(secs) AS BIGINT) AS totaltime FROM learn GROUP BY \"{c}\""
    for c in PLAY_TIMES.values())
SQL = {
    "stream_running_count": "SELECT event_type, count(*) AS num FROM events GROUP BY event_type",
    "stream_sliding_window": """
        SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(s + INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, count(*) AS num
        FROM (SELECT event_type, make_timestamp((epoch_us(ts) // 6000000 - k) * 6000000) AS s
              FROM events, generate_series(0, 9) g(k))
        GROUP BY s, event_type""",
    "stream_play_totals": I.with_ctes(["learn"], _TOTALS),
    "stream_learn_totals": I.with_ctes(["learn"], _TOTALS),
    "stream_play_coverage": I.with_ctes(["learn"], f"""
        SELECT userid, cwareid, videoid, play_interval, totaltime, effecttime, completetime
        FROM ({LOG_DURATIONS_SQL}) JOIN ({INTERVALS_SQL}) USING (userid, cwareid, videoid)"""),
    "stream_point_mastery": f"SELECT *, '2030-01-01 00:00:00' AS updatetime FROM ({MASTERY_SQL})",
    "stream_point_questions": I.with_ctes(["answers"], """
        SELECT userid, courseid, pointid, string_agg(questionid, ',' ORDER BY questionid) AS questionids,
               min(createtime) AS createtime, '2030-01-01 00:00:00' AS updatetime
        FROM (SELECT userid, courseid, pointid, questionid, min(createtime) AS createtime FROM answers
              GROUP BY userid, courseid, pointid, questionid) GROUP BY userid, courseid, pointid"""),
    "stream_page_jump_rate": I.with_ctes(["pages"], f"""
        SELECT last_page_id, pages.page_id, next_page_id, count(*) AS num, jump_rate
        FROM pages LEFT JOIN ({FUNNEL_SQL}) f ON CAST(pages.page_id AS INTEGER) = f.page_id
        GROUP BY ALL"""),
    "stream_page_funnel": FUNNEL_SQL,
    "stream_region_topk": I.with_ctes(["geo", "pages"],
                                      f"SELECT * FROM ({REGION_SQL}) ORDER BY num DESC, province LIMIT 3"),
    "stream_keyed_counts": """
        SELECT CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS INTEGER) AS id,
               CASE event_type WHEN 'view' THEN 'PC' WHEN 'click' THEN 'APP' ELSE 'Other' END AS servicetype,
               count(*) AS count FROM events GROUP BY 1, 2""",
    "stream_land_raw": """
        SELECT event_id || '|' || props AS value, event_type AS topic, strftime(ts, '%Y%m%d') AS dt FROM events""",
}
