"""Tables as numbered commits: Parquet folders ``_commit_ts=N``, of which a key's newest row counts.

A commit written again replaces itself, so a repeated batch changes nothing. Every ``FOLD`` commits one holds the newest
row of every key, and commits older than the last such one are deleted: a table has at most twice as many folders however
long it lives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursemill.operators.sinks import spread_for_partitions, write_overwrite
from coursemill.operators.versioned import COMMIT, latest_by_key

FOLD = 50  # commits from one full commit to the next


def write_commit(rows: DataFrame, path: str, number: int, keys: list[str] | None = None, fold: int = FOLD) -> None:
    """Write ``rows`` as commit ``number``; with ``keys``, every ``fold`` numbers all rows by key."""
    spark = rows.sparkSession
    rows = rows.withColumn(COMMIT, F.lit(number).cast("bigint"))
    full = keys is not None and number > 0 and number % fold == 0
    if full:
        # Folders that an earlier run of this commit has deleted are older than the full commit before.
        stored = spark.read.schema(rows.schema).parquet(path).where(F.col(COMMIT) < number)
        rows = latest_by_key(stored.unionByName(rows), keys, [COMMIT]).withColumn(COMMIT, F.lit(number).cast("bigint"))
    write_overwrite(spread_for_partitions(rows, [COMMIT]), path, [COMMIT])
    if full:
        drop_commits(spark, path, number - fold)


def drop_commits(spark: SparkSession, path: str, below: int) -> None:
    """Delete the commits numbered under ``below``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(place):
        name, _, number = status.getPath().getName().partition("=")
        if name == COMMIT and int(number) < below:
            files.delete(status.getPath(), True)


def current_rows(spark: SparkSession, path: str, keys: list[str], schema: StructType, before: int | None = None) -> DataFrame:
    """The newest row of each key over all commits, or those numbered under ``before``."""
    full = StructType(list(schema.fields)).add(COMMIT, "long")
    stored = spark.read.schema(full).parquet(path)
    if before is not None:
        stored = stored.where(F.col(COMMIT) < before)
    return latest_by_key(stored, keys, [COMMIT]).drop(COMMIT)


def next_commit(spark: SparkSession, path: str) -> int:
    """The number after the last commit; only folder names are looked at."""
    last = spark.read.schema(StructType().add(COMMIT, "long")).parquet(path).agg(F.max(COMMIT)).first()[0]
    return 0 if last is None else last + 1
