"""Tables with a primary key.

The frame functions say what a change does to a table. The ``apply_*`` functions do it to a stored one, a table of numbered
commits: a change is written as a commit of the rows it makes, a deleted key as a row that says so. Only rows that change
are written, and a commit is there whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursemill.operators.commits import current_rows, next_commit, write_commit
from coursemill.operators.sinks import replace_table
from coursemill.operators.versioned import COMMIT
from coursemill.sources.tables import table_exists

BATCH = "_batch"
DELETED = "_deleted"


# --- what a change does --------------------------------------------------------

def unique_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the newest by ``order``; of several, or without it, the largest, so that arrival does not matter."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    newest = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order or [])], F.struct(*rest).alias("_r"))
    return df.groupBy(*keys).agg(F.max(newest).alias("_n")).select(*keys, "_n._r.*").select(*df.columns)


def keyed_insert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows whose key is new; a key that exists keeps its row."""
    fresh = unique_by_key(rows.select(*table.columns), keys)
    return table.unionByName(fresh.join(table.select(*keys), keys, "left_anti"))


def keyed_update(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Set the given columns of rows that exist; other keys are ignored. Of a key's changes the newest by ``order`` holds."""
    changes = unique_by_key(rows, keys, order).withColumn("_hit", F.lit(True)).alias("c")
    new = set(rows.columns) - set(keys)
    t = table.alias("t")
    on = [F.col(f"t.{k}") == F.col(f"c.{k}") for k in keys]
    cols = [F.when(F.col("c._hit"), F.col(f"c.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in new
            else F.col(f"t.{c}") for c in table.columns]
    return t.join(changes, on, "left").select(*cols)


def keyed_delete(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the rows whose key is listed."""
    return table.join(rows.select(*keys), keys, "left_anti").select(*table.columns)


def keyed_upsert(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Replace rows that exist, add the others. ``order``: columns of ``rows`` by which the newest row of a key is found."""
    fresh = unique_by_key(rows, keys, order).select(*table.columns)
    return keyed_delete(table, fresh, keys).unionByName(fresh)


def keyed_add(table: DataFrame, rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Add ``sums`` to the stored values, starting from zero; other columns take the new value."""
    other = [c for c in table.columns if c not in keys and c not in sums]
    tagged = table.withColumn("_new", F.lit(0)).unionByName(rows.select(*table.columns).withColumn("_new", F.lit(1)))
    aggs: list[Column] = [F.sum(c).cast(dict(table.dtypes)[c]).alias(c) for c in sums]
    if other:
        aggs.append(F.max(F.struct("_new", *other)).alias("_r"))
    out = tagged.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *sums, *[F.col(f"_r.{c}").alias(c) for c in other]).select(*table.columns)


# --- doing it to a stored table ----------------------------------------------------

def _full(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add(BATCH, "long").add(DELETED, "boolean")


def keyed_create(spark: SparkSession, path: str, schema: StructType) -> None:
    """An empty keyed table: a commit without rows."""
    replace_table(spark.createDataFrame([], _full(schema)), f"{path}/{COMMIT}=-1")


def keyed_exists(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, path)


def read_keyed(spark: SparkSession, path: str, keys: list[str], schema: StructType | None = None) -> DataFrame:
    """The rows of the table; filters on keys reach the files."""
    if schema is None:
        schema = StructType([f for f in spark.read.parquet(path).schema if f.name not in (BATCH, DELETED, COMMIT)])
    return _rows(spark, path, keys, schema).drop(BATCH)


def _rows(spark: SparkSession, path: str, keys: list[str], schema: StructType) -> DataFrame:
    return current_rows(spark, path, keys, _full(schema)).where(~F.col(DELETED)).drop(DELETED)


def _touched(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(rows.select(*keys), keys, "left_semi").select(*table.columns)


def _commit(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], deleted: bool = False) -> None:
    if BATCH not in rows.columns:
        rows = rows.withColumn(BATCH, F.lit(None).cast("bigint"))
    write_commit(rows.withColumn(DELETED, F.lit(deleted)), path, next_commit(spark, path), keys)


def apply_insert(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], schema: StructType) -> None:
    old = read_keyed(spark, path, keys, schema)
    _commit(spark, path, unique_by_key(rows.select(*schema.names), keys).join(old.select(*keys), keys, "left_anti"), keys)


def apply_update(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], schema: StructType,
                 order: list[str] | None = None) -> None:
    old = _touched(_rows(spark, path, keys, schema), rows, keys)
    _commit(spark, path, keyed_update(old, rows, keys, order), keys)


def apply_delete(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], schema: StructType) -> None:
    _commit(spark, path, _touched(read_keyed(spark, path, keys, schema), rows, keys), keys, deleted=True)


def apply_upsert(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], schema: StructType,
                 order: list[str] | None = None) -> None:
    _commit(spark, path, unique_by_key(rows, keys, order).select(*schema.names), keys)


def apply_add(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], sums: list[str],
              schema: StructType, batch: int) -> None:
    """Add a numbered batch once: a key that already holds this batch, or a later one, is left as it is."""
    old = _touched(_rows(spark, path, keys, schema), rows, keys)
    done = old.where(F.col(BATCH) >= F.lit(batch)).select(*keys)
    todo = rows.select(*schema.names).join(done, keys, "left_anti").withColumn(BATCH, F.lit(batch).cast("bigint"))
    _commit(spark, path, keyed_add(_touched(old, todo, keys), todo, keys, sums), keys)
