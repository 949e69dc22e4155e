"""Reading what Spark keeps in its state store, and keeping results that are made of several of its groups.

A streaming aggregation hands out, batch by batch, the groups that changed. A result over groups of groups (a video over
its ranges, a point over its questions) needs the unchanged groups beside them as well: they are read from the state
store as it was before the batch. So nothing is stored twice, and only results that changed are written.

Reading the state is one parallel scan of it. Spark keeps the state of the last batches only, so it does not grow with
their number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from coursemill.streaming.sinks import AVAILABLE


def keep_state(df: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Run a streaming aggregation for its state alone; ``state_rows`` reads it, now or later."""
    return (df.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE)).start())


def state_rows(spark: SparkSession, checkpoint: str, keys: list[str], values: list[str], batch: int | None = None) -> DataFrame:
    """The groups of a streaming aggregation after a batch (the last one if none is given).

    ``keys`` and ``values`` name the grouping columns and the aggregates in their order; an aggregate must be one whose
    running value is its result, as of counts, sums of whole numbers, minima and maxima.
    """
    reader = spark.read.format("statestore")
    rows = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    parts = []
    for part, names in (("key", keys), ("value", values)):
        held = rows.schema[part].dataType.fields
        if len(held) != len(names):
            raise ValueError(f"the state holds {[f.name for f in held]}, not {names}")
        parts.append(F.col(part).cast(StructType([StructField(n, f.dataType) for n, f in zip(names, held)])).alias(part))
    return rows.select(*parts).select("key.*", "value.*")


def same(left: str, right: str, columns: list[str]):
    """Condition that two aliased frames agree in columns, nulls included."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def whole_groups(changed: DataFrame, before: DataFrame | None, keys: list[str], group: list[str]) -> DataFrame:
    """The changed rows and, of the rows ``before``, the unchanged ones that share ``group`` with one of them (all, if it is empty)."""
    if before is None:
        return changed
    rest = before.alias("b")
    if group:
        rest = rest.join(changed.select(*group).distinct().alias("t"), same("b", "t", group), "left_semi")
    rest = rest.join(changed.select(*keys).alias("n"), same("b", "n", keys), "left_anti")
    return changed.unionByName(rest.select(*changed.columns))
