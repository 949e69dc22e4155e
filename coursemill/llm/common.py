"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursemill.session import scratch_dir

#: White space of the word rules: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Compute once and keep the rows in the shared checkpoint folder, so that losing an executor loses nothing.

    What was shuffled for them is deleted at once: nothing reads it again, and else it stays until the driver happens to
    collect its garbage. The rows get a plan of their own for that, so frames that ``df`` is made of keep what they hold.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return df.select("*").checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row; a plain alias is computed again inside each lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What runs inside has this setting of the session."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def arrow_batches(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """What runs inside sends Python so many rows at once: whole texts in batches of ten thousand take much memory."""
    return setting(spark, BATCH, str(rows))


def few_rows_to_python(spark: SparkSession, rows: int) -> None:
    """The session sends Python at most so many rows at once from here on: for frames that run only when they are written."""
    if not 0 < int(spark.conf.get(BATCH)) <= rows:
        spark.conf.set(BATCH, str(rows))


def shield(docs: DataFrame, own: list[str], added: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Columns other than ``own`` under names that no operator uses, and what gives them their names back.

    Input columns named like ``added`` ones are dropped.
    """
    prefix = "_beside"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    names = {c: f"{prefix}{i}" for i, c in enumerate(docs.columns) if c not in own and c not in added}
    return (docs.drop(*[c for c in added if c not in own]).withColumnsRenamed(names),
            lambda out: out.withColumnsRenamed({v: k for k, v in names.items()}))


def running_sums(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add for each ``name: column`` the sum of that column over all rows before this one in ``order``.

    Rows are dealt to tasks by ranges of ``order``; only one row per task meets in a single place.
    """
    parts = saved(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*(F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()))
    offsets = totals.select("_part", *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(offsets, "_part")
    for name, column in sums.items():
        out = out.withColumn(name, F.col(f"_off_{name}") + F.coalesce(F.sum(column).over(inside), F.lit(0)))
    return out.drop("_part", *(f"_off_{n}" for n in sums))
