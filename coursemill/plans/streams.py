"""Streaming jobs from a log to the tables they keep: a topic, or a folder that text files are put into."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursemill.functions.cleaning import app_name
from coursemill.sources.lines import json_lines_to_table, tsv_fields
from coursemill.sources.specs import ANSWER_TSV, REGISTER_TSV, spec
from coursemill.sources.streams import RATE_CAPS, rate_limit, read_log_stream, row_bytes
from coursemill.sources.tables import read_folder, table_path
from coursemill.streaming import jobs
from coursemill.streaming.learn import run_learn

PARTITIONS = 10  # fixed value: partitions a topic is taken to have


def log(spark: SparkSession, source: str, servers: str | None, topic: str, rate: str, limited: bool) -> DataFrame:
    """Lines of a log: of topic ``source`` at ``servers``, or of the text files below folder ``source``."""
    if servers:
        return read_log_stream(spark, "kafka", topic=source, servers=servers, cap=rate_limit("kafka", RATE_CAPS[rate], PARTITIONS))
    cap = rate_limit("text", RATE_CAPS[rate], PARTITIONS, size=row_bytes(spark, "text", source)) if limited else None
    return read_log_stream(spark, "text", path=source, topic=topic, cap=cap)


def learn(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, trigger: dict | None) -> list[StreamingQuery]:
    plays = json_lines_to_table(lines, spec("learn_event")).withColumnRenamed("uid", "userid")
    return [run_learn(spark, plays, table_path(root, "rt.learn"), f"{checkpoint}/learn", trigger)]


def points(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, trigger: dict | None) -> list[StreamingQuery]:
    return [jobs.run_point_mastery(spark, tsv_fields(lines, ANSWER_TSV), table_path(root, "rt.points"), f"{checkpoint}/points", trigger)]


def pages(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, trigger: dict | None) -> list[StreamingQuery]:
    """Transitions with their rates, and visits by province from the address ranges in ``dim.ip_region``."""
    visits = json_lines_to_table(lines, spec("page_event"))
    ranges = read_folder(spark, table_path(root, "dim.ip_region"))
    return [jobs.run_page_transitions(spark, visits, table_path(root, "rt.page_jump_rate"), f"{checkpoint}/page_jump_rate", trigger),
            jobs.run_region_topk(spark, visits, ranges, table_path(root, "rt.city_num_detail"), table_path(root, "rt.top_city_num"),
                                 f"{checkpoint}/top_city_num", trigger=trigger)]


def registrations(lines: DataFrame) -> DataFrame:
    return tsv_fields(lines, REGISTER_TSV).select(app_name(F.col("app_code")).alias("servicetype"),
                                                  F.col("registered_at").try_cast("timestamp").alias("ts"))


def register(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, trigger: dict | None) -> list[StreamingQuery]:
    """Registrations per app: since the beginning (in the state store) and in windows."""
    rows = registrations(lines)
    return [jobs.run_running_counts(rows, "servicetype", f"{checkpoint}/register_total", trigger),
            jobs.run_window_counts(rows, "ts", "servicetype", table_path(root, "rt.register_window"), f"{checkpoint}/register_window", trigger)]


def keyed(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, trigger: dict | None) -> list[StreamingQuery]:
    return [jobs.run_keyed_counts(registrations(lines), table_path(root, "rt.register_keyed"), f"{checkpoint}/register_keyed", trigger)]


def land(spark: SparkSession, lines: DataFrame, root: str, checkpoint: str, trigger: dict | None) -> list[StreamingQuery]:
    return [jobs.run_land_raw(lines, table_path(root, "raw.logs"), f"{checkpoint}/land", trigger)]


# fixed values: job -> (function, name of its log, rate cap)
STREAMS: dict[str, tuple[Callable, str, str]] = {
    "stream-learn": (learn, "course_learn", "course"),
    "stream-points": (points, "qz_log", "point"),
    "stream-pages": (pages, "page_topic", "page"),
    "stream-register": (register, "register_topic", "register"),
    "stream-keyed": (keyed, "register_topic", "keyed"),
    "stream-land": (land, "raw", "land_raw"),
}


def start(spark: SparkSession, job: str, root: str, source: str, servers: str | None = None, once: bool = False) -> list[StreamingQuery]:
    """Start a job's queries: every three seconds, or ``once`` over all that is there."""
    run, topic, rate = STREAMS[job]
    lines = log(spark, source, servers, topic, rate, not once)
    return run(spark, lines, root, f"{root.rstrip('/')}/_checkpoints", jobs.AVAILABLE if once else jobs.EVERY_3_SECONDS)


def run(spark: SparkSession, job: str, root: str, source: str, servers: str | None = None, once: bool = False) -> None:
    queries = start(spark, job, root, source, servers, once)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
