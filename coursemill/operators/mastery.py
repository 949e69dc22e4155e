"""How well a learner masters a point of knowledge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import ids_to_text

POINT = ["userid", "courseid", "pointid"]
POINT_QUESTIONS = 30  # fixed value: questions a point is taken to have


def answer_counts(answers: DataFrame) -> DataFrame:
    """Attempts per learner, point and question: small, and additive across batches."""
    return answers.groupBy(*POINT, "questionid").agg(
        F.count(F.lit(1)).alias("qz_sum"),
        F.count_if(F.col("istrue") == "1").alias("qz_istrue"),
        F.min("createtime").alias("createtime"))


def mastery_from_counts(counts: DataFrame, total: int = POINT_QUESTIONS) -> DataFrame:
    """Mastery of each point out of the per-question counts."""
    sums = counts.groupBy(*POINT).agg(
        F.sum("qz_sum").alias("qz_sum"),
        F.count(F.lit(1)).alias("qz_count"),
        F.sum("qz_istrue").alias("qz_istrue"),
        F.min("createtime").alias("createtime"))
    rate = F.col("qz_istrue").cast("double") / F.col("qz_sum").cast("double")
    return sums.withColumn("correct_rate", rate).withColumn(
        "mastery_rate", F.col("qz_count").cast("double") / F.lit(total) * F.col("correct_rate"))


def questions_from_counts(counts: DataFrame) -> DataFrame:
    """The different question ids of each point as sorted comma text, and when the first was answered."""
    return counts.groupBy(*POINT).agg(ids_to_text(F.array_sort(F.collect_list("questionid"))).alias("questionids"),
                                      F.min("createtime").alias("createtime"))


def point_mastery(answers: DataFrame, total: int = POINT_QUESTIONS) -> DataFrame:
    """Different questions, attempts, right answers, correct rate and mastery per point.

    Two additive stages, per question and then per point, stand in for a set
    of ids: no group is ever gathered.
    """
    return mastery_from_counts(answer_counts(answers), total)


def point_questions(answers: DataFrame) -> DataFrame:
    """The different question ids of each point as sorted comma text."""
    return (answers.groupBy(*POINT, "questionid").agg(F.first(F.lit(1)).alias("_"))
            .groupBy(*POINT).agg(ids_to_text(F.array_sort(F.collect_list("questionid"))).alias("questionids")))


def explode_groups(groups: DataFrame, column: str) -> DataFrame:
    """One row per element of a list column."""
    return groups.withColumn(column, F.explode(column))
