"""Streaming sinks.

Results are written as numbered commits of the rows that changed: a batch that is repeated after a failure overwrites its
own commit, so results are exact however often a batch runs, also where one batch writes several tables.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from coursemill.operators.commits import FOLD, current_rows, write_commit
from coursemill.operators.sinks import replace_table

AVAILABLE = {"availableNow": True}


def start(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "update",
          trigger: dict | None = None) -> StreamingQuery:
    """Run ``each(batch, number)`` per micro-batch; offsets are stored after it returns."""
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE)).foreachBatch(each).start())


def stop_gracefully(query: StreamingQuery, poll: float = 0.1) -> None:
    """Stop between two micro-batches rather than in the middle of one."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(poll)
    query.stop()


def append_commits(path: str, keys: list[str] | None = None, fold: int = FOLD) -> Callable[[DataFrame, int], None]:
    """Write every batch as commit number ``batch`` below ``path``; with ``keys``, every ``fold`` batches all rows by key."""
    return lambda batch, number: write_commit(batch, path, number, keys, fold)


def read_state(spark: SparkSession, path: str, keys: list[str], schema: StructType) -> DataFrame:
    """The newest row of each key over all commits of a stream."""
    return current_rows(spark, path, keys, schema)


def compact(spark: SparkSession, path: str, keys: list[str], schema: StructType, out: str) -> None:
    """Write the current rows as a table of one commit, for streams that have run for long."""
    replace_table(read_state(spark, path, keys, schema), out)
