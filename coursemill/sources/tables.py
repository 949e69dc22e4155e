"""Warehouse tables: Parquet folders below one root, addressed ``layer.table``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from coursemill.sources.specs import SCANS


def table_path(root: str, name: str) -> str:
    layer, _, table = name.partition(".")
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_folder(spark, table_path(root, name))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A table by its folder. ``dt`` and ``dn`` are folder names; by itself Spark would read a day, or a name like 007, as a number."""
    reader = spark.read.option("basePath", path)
    found = reader.parquet(path)
    text = StructType([StructField(f.name, StringType(), f.nullable) if f.name in ("dt", "dn") else f for f in found.schema])
    return found if text == found.schema else reader.schema(text).parquet(path)


def parse_columns(text: str) -> list[tuple[str, str, str | None]]:
    """``a>b`` and ``a::type`` tokens to (source, name, type)."""
    out = []
    for token in text.split():
        source, _, cast = token.partition("::")
        source, _, name = source.partition(">")
        out.append((source, name or source, cast or None))
    return out


def project(df: DataFrame, columns: str) -> DataFrame:
    """Select, rename and cast by a column list such as ``a b>c d::int``."""
    def one(source: str, name: str, cast: str | None) -> Column:
        c = F.col(source)
        return (c.try_cast(cast) if cast else c).alias(name)
    return df.select(*[one(*t) for t in parse_columns(columns)])


def partition_filter(df: DataFrame, dt: str | None) -> DataFrame:
    """Keep one day; compared as text, so that folders are pruned."""
    return df if dt is None else df.where(F.col("dt") == F.lit(str(dt)))


def scan_table(df: DataFrame, columns: str, dt: str | None = None) -> DataFrame:
    """One warehouse scan: a day of a table, projected by a column list."""
    return project(partition_filter(df, dt), columns)


def scan(spark: SparkSession, root: str, name: str, dt: str | None = None) -> DataFrame:
    """One of the named scans in ``SCANS``."""
    table, columns = SCANS[name]
    return scan_table(read_table(spark, root, table), columns, dt)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if a Parquet table with at least one file can be read at ``path``."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def read_state_table(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """Earlier totals for a merge: a Parquet folder, or a database table through JDBC options.

    A large database table should name ``partitionColumn`` with its bounds and
    ``numPartitions`` among the options; otherwise one task reads it all.
    """
    return spark.read.format("jdbc").options(**jdbc).load() if jdbc else spark.read.parquet(path)


def register_table(spark: SparkSession, path: str, name: str) -> None:
    """Publish a Parquet folder in the catalog, with its partitions; ``dt`` and ``dn`` are text there too."""
    found = read_folder(spark, path)
    folders = [f.name for f in found.schema if f.name in _folder_columns(spark, path)]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in folders)})" if folders else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{path}'")
    if folders:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _folder_columns(spark: SparkSession, path: str) -> set[str]:
    """Columns that are folder names: those that a file itself lacks."""
    rows = spark.read.option("basePath", path).parquet(path)
    own = spark.read.option("recursiveFileLookup", True).parquet(path)
    return set(rows.columns) - set(own.columns)
