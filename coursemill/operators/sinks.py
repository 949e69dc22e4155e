"""Writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.sources.specs import BUCKETS


def _writer(df: DataFrame, mode: str, partitions: list[str]):
    w = df.write.mode(mode).option("compression", "snappy")
    return w.partitionBy(*partitions) if partitions else w


def spread_for_partitions(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Gather the rows of each output folder, so that not every task writes a file into every folder.

    Spark sizes the tasks at run time: small folders share one, a folder that
    holds a large part of the rows is split over several.
    """
    return df.hint("rebalance", *partitions) if partitions else df


def write_append(df: DataFrame, path: str, partitions: list[str] = ("dt", "dn")) -> None:
    """Append to a partitioned table; columns are written by name."""
    _writer(df, "append", list(partitions)).parquet(path)


def write_overwrite(df: DataFrame, path: str, partitions: list[str] = ("dt", "dn")) -> None:
    """Replace the partitions the frame has rows for and leave the others alone."""
    (_writer(df, "overwrite", list(partitions)).option("partitionOverwriteMode", "dynamic").parquet(path))


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    _writer(df, "overwrite", []).option("partitionOverwriteMode", "static").parquet(path)


EMPTY = "_empty"  # true in the row that stands for a partition without rows


def replace_partitions(rows: DataFrame, touched: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions of ``rows`` and those listed in ``touched``, in one write, by rows computed from the table.

    Spark replaces the partitions it has rows for, so each one listed gets a row that says it may be empty;
    ``read_partitions`` leaves these out. All new folders are written before the first is moved into place.
    """
    marks = touched.select(partition).distinct().withColumn(EMPTY, F.lit(True))
    both = rows.withColumn(EMPTY, F.lit(False)).unionByName(marks, allowMissingColumns=True)
    write_overwrite(spread_for_partitions(both, [partition]), path, [partition])


def read_partitions(df: DataFrame) -> DataFrame:
    """The rows of a table kept by ``replace_partitions``."""
    return df.where(~F.col(EMPTY)).drop(EMPTY)


def limit_files(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` output files, by a shuffle so that the work before it stays parallel."""
    return df.repartition(n)


def write_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int = BUCKETS,
                   partitions: list[str] = ("dt", "dn"), mode: str = "append") -> None:
    """Partitioned table, bucketed and sorted by one column.

    Rows are brought to their bucket first, so each folder gets one file per
    bucket instead of one per task and bucket. A value that owns a large share
    of the rows would own its bucket too: see ``split_hot``.
    """
    w = df.repartition(buckets, column).write.mode(mode).option("path", path).option("compression", "snappy")
    if partitions:
        w = w.partitionBy(*partitions)
    w.bucketBy(buckets, column).sortBy(column).format("parquet").saveAsTable(name)


def split_hot(df: DataFrame, column: str, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """(rows fit for bucketing, rows of values with more than ``min_rows`` rows).

    A bucket is read by one task and cannot be split, so hot values are kept
    beside the bucketed table, where a join may spread them.
    """
    hot = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_rows).select(column)
    return df.join(hot, [column], "left_anti").select(*df.columns), df.join(hot, [column], "left_semi").select(*df.columns)
