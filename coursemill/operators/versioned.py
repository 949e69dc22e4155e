"""Tables that keep every commit, as Parquet folders per commit time.

Merge-on-read appends each commit and picks the newest row of a key when it is
read. Copy-on-write rewrites the partitions a commit touches, so reads need no
merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from coursemill.functions.scalars import partition_path
from coursemill.operators.sinks import EMPTY, _writer, read_partitions, replace_partitions, write_overwrite
from coursemill.sources.tables import table_exists

COMMIT = "_commit_ts"


def derive_partition_path(df: DataFrame, ts: str, key: str = "uid", columns: tuple[str, ...] = ("dt", "dn"),
                          name: str = "partitionpath") -> DataFrame:
    """Commit stamp, record key copy and ``dt/dn`` path of a lake row."""
    return df.withColumns({"ts": F.lit(ts), "uuid": F.col(key), name: partition_path(*columns)})


def typed_map(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Set one column of every row."""
    return df.withColumn(column, value)


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; the filter on rank 1 is applied inside each task before the shuffle."""
    ties = [c for c in df.columns if c not in keys and c not in order]
    last = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order], *[F.desc(c) for c in ties])
    return df.withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") == 1).drop("_rn")


def versioned_insert(df: DataFrame, path: str, keys: list[str], precombine: str, commit: int) -> None:
    """First commit: replaces whatever is at ``path``."""
    rows = latest_by_key(df, keys, [precombine]).withColumn(COMMIT, F.lit(commit).cast("bigint"))
    (_writer(rows, "overwrite", [COMMIT]).option("partitionOverwriteMode", "static").parquet(path))


def versioned_upsert(df: DataFrame, path: str, keys: list[str], precombine: str, commit: int) -> None:
    """A later commit. Writing the same commit again replaces it, so a retry is harmless."""
    rows = latest_by_key(df, keys, [precombine]).withColumn(COMMIT, F.lit(commit).cast("bigint"))
    write_overwrite(rows, path, [COMMIT])


def read_commits(spark: SparkSession, path: str, begin: int | None = None, end: int | None = None) -> DataFrame:
    """Committed rows in (begin, end]; the bounds prune folders."""
    df = spark.read.parquet(path).withColumn(COMMIT, F.col(COMMIT).cast("bigint"))
    if begin is not None:
        df = df.where(F.col(COMMIT) > begin)
    if end is not None:
        df = df.where(F.col(COMMIT) <= end)
    return df


def read_snapshot(spark: SparkSession, path: str, keys: list[str], precombine: str) -> DataFrame:
    """The current row of each key: largest precombine value, then latest commit."""
    return latest_by_key(read_commits(spark, path), keys, [precombine, COMMIT])


def read_incremental(spark: SparkSession, path: str, keys: list[str], precombine: str, begin: int) -> DataFrame:
    """Current rows that were committed after ``begin``; a row that an older commit still outranks is not handed out."""
    return read_snapshot(spark, path, keys, precombine).where(F.col(COMMIT) > begin)


def read_between(spark: SparkSession, path: str, keys: list[str], precombine: str, begin: int,
                 end: int) -> DataFrame:
    """Rows that were current at ``end`` and committed in (begin, end]."""
    return latest_by_key(read_commits(spark, path, end=end), keys, [precombine, COMMIT]).where(F.col(COMMIT) > begin)


def cow_upsert(spark: SparkSession, df: DataFrame, path: str, keys: list[str], precombine: str, partition: str,
               commit: int) -> None:
    """Copy-on-write commit into a table with one folder per ``partition`` value.

    Touched are the folders of the new rows and those that hold an older row of
    the same keys, since a key whose partition changed has to leave its old one.
    They are written anew in one dynamic overwrite, the others not at all.
    """
    # An empty partition value is stored as the default folder and reads back as null.
    df = df.withColumn(partition, F.when(F.col(partition).cast("string") != "", F.col(partition)))
    rows = latest_by_key(df, keys, [precombine]).withColumn(COMMIT, F.lit(commit).cast("bigint"))
    if not table_exists(spark, path):
        replace_partitions(rows, rows, path, partition)
        return
    stored = read_cow(spark, path, rows.schema)
    old = stored.join(rows.select(*keys), keys, "left_semi").select(partition)
    touched = old.union(rows.select(partition)).distinct()
    same = F.col(f"s.{partition}").eqNullSafe(F.col(f"t.{partition}"))
    kept = stored.alias("s").join(touched.alias("t"), same, "left_semi").select(*rows.columns)
    replace_partitions(latest_by_key(kept.unionByName(rows), keys, [precombine, COMMIT]), touched, path, partition)


def read_cow(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a copy-on-write table; ``schema`` includes the commit."""
    return read_partitions(spark.read.schema(StructType(list(schema.fields)).add(EMPTY, "boolean")).parquet(path)).select(*schema.names)
