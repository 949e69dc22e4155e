"""Logs to detail tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from coursemill.operators.joins import HOT_ROWS
from coursemill.operators.sinks import limit_files, split_hot, write_append, write_bucketed, write_overwrite
from coursemill.operators.versioned import derive_partition_path, versioned_insert, versioned_upsert
from coursemill.sources.lines import json_lines_to_table, read_lines
from coursemill.sources.specs import BUCKETED, BUCKETS, FIELDS, LOG_OF_CLUSTER, spec
from coursemill.sources.tables import table_path

DETAIL_TABLES = [t for t in FIELDS if t.startswith("dwd_")]
AREAS = {
    "member": [t for t in DETAIL_TABLES if not t.startswith(("dwd_qz", "dwd_sale", "dwd_course"))],
    "questions": [t for t in DETAIL_TABLES if t.startswith("dwd_qz")],
    "sales": [t for t in DETAIL_TABLES if t.startswith(("dwd_sale", "dwd_course"))],
}


def log_path(ods: str, table: str) -> str:
    return f"{ods.rstrip('/')}/{LOG_OF_CLUSTER.get(table, table)}.log"


def hot_path(root: str, table: str) -> str:
    """Rows of values too frequent for one bucket."""
    return table_path(root, f"dwd.{table}_hot")


def load_detail(spark: SparkSession, ods: str, root: str, table: str, files: int | None = None,
                buckets: int = BUCKETS) -> None:
    """Clean one log and add it to its detail table; lookup tables are replaced.

    The number of output files follows the input unless ``files`` asks for a
    certain one, which costs a shuffle.
    """
    s = spec(table)
    rows = json_lines_to_table(read_lines(spark, log_path(ods, table)), s)
    if files:
        rows = limit_files(rows, files)
    path = table_path(root, f"dwd.{table}")
    if table in BUCKETED:
        rows, hot = split_hot(rows, BUCKETED[table], HOT_ROWS)
        write_bucketed(rows, table, path, BUCKETED[table], buckets, list(s.partitions), s.mode)
        write_append(hot, hot_path(root, table), list(s.partitions))
    elif s.mode == "append":
        write_append(rows, path, list(s.partitions))
    else:
        write_overwrite(rows, path, list(s.partitions))


def load_area(spark: SparkSession, ods: str, root: str, area: str) -> None:
    for table in AREAS[area]:
        load_detail(spark, ods, root, table)


def load_lake_member(spark: SparkSession, log: str, path: str, commit: int, first: bool = False) -> None:
    """The member log as one commit of a versioned table keyed by uid."""
    rows = derive_partition_path(json_lines_to_table(read_lines(spark, log), spec("lake_member")), str(commit))
    write = versioned_insert if first else versioned_upsert
    write(rows, path, ["uuid"], "ts", commit)
