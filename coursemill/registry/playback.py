"""Video play time and mastery of points."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions.scalars import id_set_union as _union
from coursemill.functions.scalars import ids_to_text, text_to_ids
from coursemill.operators import mastery as K
from coursemill.operators import playback as P
from coursemill.registry import inputs as I
from coursemill.sources.lines import json_lines_to_table
from coursemill.sources.specs import spec


def learn(spark: SparkSession, sf: str) -> DataFrame:
    return I.learn(I.events(spark, sf))


def answers(spark: SparkSession, sf: str) -> DataFrame:
    return I.answers(I.events(spark, sf))


def play_time(by: str, spark: SparkSession, sf: str) -> DataFrame:
    return P.play_time(learn(spark, sf), by)


def play_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return P.play_coverage(learn(spark, sf))


def play_durations(spark: SparkSession, sf: str) -> DataFrame:
    return P.play_durations(learn(spark, sf))


def learn_log(spark: SparkSession, sf: str) -> DataFrame:
    """Plays read from JSON lines with the fields of the learning log, which has no event id; videos are numbers there."""
    number = F.col("event_id")
    plays = learn(spark, sf).withColumns({"videoid": number % 4, "speed": number % 3 + 1}).withColumnRenamed("userid", "uid").drop("event_id")
    lines = plays.select(F.to_json(F.struct("*")).alias("value"))
    return json_lines_to_table(lines, spec("learn_event")).withColumnRenamed("uid", "userid")


def learn_log_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(P.play_coverage(learn_log(spark, sf)))


def learn_log_durations(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(P.play_durations(learn_log(spark, sf)))


def _wide(df: DataFrame) -> DataFrame:
    """Whole numbers as 64 bits, as SQL has them."""
    return df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


def play_intervals_text(spark: SparkSession, sf: str) -> DataFrame:
    return P.play_intervals_text(learn(spark, sf))


def point_mastery(spark: SparkSession, sf: str) -> DataFrame:
    return K.point_mastery(answers(spark, sf))


def id_set_union(spark: SparkSession, sf: str) -> DataFrame:
    """Question ids of each point: the right ones first, then the wrong ones that are new."""
    rows = answers(spark, sf)
    right = K.point_questions(rows.where("istrue = '1'")).withColumnRenamed("questionids", "a")
    wrong = K.point_questions(rows.where("istrue = '0'")).withColumnRenamed("questionids", "b")
    both = _union(text_to_ids(F.col("a")), text_to_ids(F.col("b")))
    return right.join(wrong, K.POINT, "full").select(
        *K.POINT, ids_to_text(F.array_sort(both)).alias("questionids"), F.size(both).alias("qz_count"))


def explode_groups(spark: SparkSession, sf: str) -> DataFrame:
    lists = K.point_questions(answers(spark, sf)).withColumn("questionid", text_to_ids(F.col("questionids")))
    return K.explode_groups(lists.drop("questionids"), "questionid")


QUERIES = {
    **{key: partial(play_time, by) for key, by in P.PLAY_TIMES.items()},
    "play_coverage": play_coverage, "play_durations": play_durations, "play_intervals_text": play_intervals_text,
    "learn_log_coverage": learn_log_coverage, "learn_log_durations": learn_log_durations, "point_mastery": point_mastery, "id_set_union": id_set_union, "explode_groups": explode_groups,
}

_FRESH = """
    SELECT *, greatest(pe - greatest(ps, coalesce(max(pe) OVER (
               PARTITION BY userid, cwareid, videoid ORDER BY ps, pe, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ps)), 0) AS fresh FROM learn"""
#: The same in logs without an event id: plays of one range in order of their times.
_LOG_FRESH = _FRESH.replace("event_id", "ts, te")
_LOG = "SELECT * EXCLUDE (event_id) REPLACE (event_id % 4 AS videoid), event_id % 3 + 1 AS speed FROM learn"
_ISLANDS = """
    SELECT userid, cwareid, videoid, min(ps) AS s, max(pe) AS e FROM (
        SELECT *, sum(CASE WHEN reached IS NULL OR ps > reached THEN 1 ELSE 0 END) OVER (
                   PARTITION BY userid, cwareid, videoid ORDER BY ps, pe, event_id) AS island
        FROM (SELECT *, max(pe) OVER (PARTITION BY userid, cwareid, videoid ORDER BY ps, pe, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM learn))
    GROUP BY userid, cwareid, videoid, island"""


def play_time_sql(by: str) -> str:
    return I.with_ctes(["learn"], f'SELECT "{by}", CAST(sum(secs) AS BIGINT) AS totaltime FROM learn GROUP BY "{by}"')


INTERVALS_SQL = I.with_ctes(["learn"], f"""
    SELECT userid, cwareid, videoid, string_agg(s || '-' || e, ',' ORDER BY s) AS play_interval
    FROM ({_ISLANDS}) GROUP BY userid, cwareid, videoid""")
MASTERY_SQL = I.with_ctes(["answers"], """
    SELECT *, CAST(qz_istrue AS DOUBLE) / CAST(qz_sum AS DOUBLE) AS correct_rate,
           CAST(qz_count AS DOUBLE) / 30 * (CAST(qz_istrue AS DOUBLE) / CAST(qz_sum AS DOUBLE)) AS mastery_rate
    FROM (SELECT userid, courseid, pointid, count(*) AS qz_sum, count(DISTINCT questionid) AS qz_count,
                 count(*) FILTER (istrue = '1') AS qz_istrue, min(createtime) AS createtime
          FROM answers GROUP BY userid, courseid, pointid)""")
_DURATIONS = """
    SELECT userid, cwareid, videoid, CAST(sum(secs) AS BIGINT) AS totaltime,
           CAST(sum(CAST(floor(CAST(secs AS DOUBLE) / (pe - ps) * fresh) AS BIGINT)) AS BIGINT) AS effecttime,
           CAST(sum(fresh) AS BIGINT) AS completetime FROM ({fresh}) GROUP BY userid, cwareid, videoid"""
LOG_DURATIONS_SQL = I.with_ctes(["learn"], _DURATIONS.format(fresh=_LOG_FRESH))
SQL = {
    **{key: play_time_sql(by) for key, by in P.PLAY_TIMES.items()},
    "play_coverage": I.with_ctes(["learn"], f"SELECT event_id, userid, cwareid, videoid, ps, pe, fresh FROM ({_FRESH})"),
    "play_durations": I.with_ctes(["learn"], _DURATIONS.format(fresh=_FRESH)),
    "learn_log_durations": I.with_ctes(["learn"], f"SELECT * FROM (WITH learn AS ({_LOG}) {_DURATIONS.format(fresh=_LOG_FRESH)})"),
    "learn_log_coverage": I.with_ctes(["learn"], f"""
        SELECT userid, cwareid, videoid, chapterid, edutypeid, subjectid, "sourceType", speed, ts, te, ps, pe,
               count(*) AS plays, max(fresh) AS fresh
        FROM (WITH learn AS ({_LOG}) {_LOG_FRESH}) GROUP BY ALL"""),
    "play_intervals_text": INTERVALS_SQL,
    "point_mastery": MASTERY_SQL,
    "id_set_union": I.with_ctes(["answers"], """
        SELECT userid, courseid, pointid, string_agg(questionid, ',' ORDER BY questionid) AS questionids,
               CAST(count(*) AS INTEGER) AS qz_count
        FROM (SELECT DISTINCT userid, courseid, pointid, questionid FROM answers) GROUP BY userid, courseid, pointid"""),
    "explode_groups": I.with_ctes(["answers"],
                                  "SELECT DISTINCT userid, courseid, pointid, questionid FROM answers"),
}
