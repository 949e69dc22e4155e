"""Question bank: wide tables, answer detail, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursemill.operators import joins as J
from coursemill.operators import metrics as M
from coursemill.operators.sinks import write_overwrite
from coursemill.sources.tables import partition_filter, read_table, scan, table_path

# fixed values: wide table -> (join, scans it reads)
WIDE = {
    "dws_qz_chapter": (J.chapter_join, ["qz_chapter", "qz_chapter_list", "qz_point", "qz_point_question"]),
    "dws_qz_course": (J.course_join, ["qz_site_course", "qz_course", "qz_course_edusubject"]),
    "dws_qz_major": (J.major_join, ["qz_major", "qz_website", "qz_business"]),
    "dws_qz_paper": (J.paper_join, ["qz_paper_view", "qz_center_paper", "qz_center", "qz_paper"]),
    "dws_qz_question": (J.question_join, ["qz_question", "qz_question_type"]),
}
ANSWER_INPUTS = ["answer", "answer_course", "answer_chapter", "answer_major", "answer_paper", "answer_question"]

# fixed values: report table -> report, of those read from one summary and of the others
SUMMARY_REPORTS = {
    "ads_paper_avgtimeandscore": M.avg_of,
    "ads_paper_maxdetail": M.max_min_of,
    "ads_user_paper_detail": M.pass_rate_of,
}
REPORTS = {
    "ads_top3_userdetail": M.paper_top3,
    "ads_low3_userdetail": M.paper_low3,
    "ads_paper_scoresegment_user": M.score_segment_users,
    "ads_user_question_detail": M.question_error_rate,
}


def build_question_wide(spark: SparkSession, root: str, dt: str) -> None:
    for table, (join, scans) in WIDE.items():
        write_overwrite(join(*[scan(spark, root, n, dt) for n in scans]), table_path(root, f"dws.{table}"))


def build_answer_detail(spark: SparkSession, root: str, dt: str, distinct_chapter: bool = False) -> None:
    rows = J.answer_detail_join(*[scan(spark, root, n, dt) for n in ANSWER_INPUTS], distinct_chapter=distinct_chapter)
    write_overwrite(rows, table_path(root, "dws.dws_user_paper_detail"))


def answer_detail(spark: SparkSession, root: str, dt: str) -> DataFrame:
    return partition_filter(read_table(spark, root, "dws.dws_user_paper_detail"), dt)


def build_question_reports(spark: SparkSession, root: str, dt: str) -> None:
    """Seven reports of a day; averages, extremes and pass rates come from one pass over the answers."""
    detail = answer_detail(spark, root, dt)
    summary = M.paper_summary(detail, dt).persist()
    for table, report in SUMMARY_REPORTS.items():
        write_overwrite(report(summary), table_path(root, f"ads.{table}"))
    summary.unpersist()
    for table, report in REPORTS.items():
        write_overwrite(report(detail, dt), table_path(root, f"ads.{table}"))
