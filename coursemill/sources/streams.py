"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Records per partition and second the jobs accept.
RATE_CAPS = {"land_raw": 20, "page": 100, "course": 100, "point": 100, "keyed": 100, "register": 300}
TRIGGER_SECONDS = 3


def row_bytes(spark: SparkSession, fmt: str, path: str) -> float:
    """Mean size of a stored record: bytes of the files by records in them."""
    files = (spark.read.format(fmt).load(path).groupBy("_metadata.file_path")
             .agg(F.count(F.lit(1)).alias("n"), F.first("_metadata.file_size").alias("bytes")))
    total = files.agg(F.sum("bytes"), F.sum("n")).first()
    return total[0] / total[1] if total[1] else 1.0


def rate_limit(fmt: str, cap: int, partitions: int = 1, seconds: int = TRIGGER_SECONDS, size: float | None = None) -> dict[str, str]:
    """Source options that keep one micro-batch near ``cap`` records per partition and second.

    Kafka counts records. File sources count bytes: ``size`` is that of a record, from ``row_bytes``. A batch takes whole
    files, at least one, so files larger than the cap come one by one.
    """
    records = cap * partitions * seconds
    if fmt == "kafka":
        return {"maxOffsetsPerTrigger": str(records)}
    if size is None:
        raise ValueError("files are admitted by bytes: give the size of a record")
    return {"maxBytesPerTrigger": str(max(1, round(records * size)))}


def read_log_stream(spark: SparkSession, fmt: str, *, path: str | None = None, schema: StructType | None = None,
                    topic: str | None = None, servers: str | None = None, cap: dict[str, str] | None = None,
                    options: dict[str, str] | None = None) -> DataFrame:
    """A log stream from the earliest record; later runs go on from the checkpoint.

    Topics give ``topic``, ``ts_ms`` and ``value``. So do text files if ``topic`` names what they hold, with the time of
    the file; other files give their own columns.
    """
    reader = spark.readStream.format(fmt).options(**(cap or {}), **(options or {}))
    if fmt == "kafka":
        raw = (reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
               .option("startingOffsets", "earliest").load())
        return raw.select("topic", F.unix_millis("timestamp").alias("ts_ms"), F.col("value").cast("string").alias("value"))
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path)
    if topic is None:
        return rows
    return rows.select(F.lit(topic).alias("topic"), F.unix_millis("_metadata.file_modification_time").alias("ts_ms"), "value")


def replay_lines(spark: SparkSession, path: str, out: str, files: int = 1, *, servers: str | None = None,
                 topic: str | None = None) -> None:
    """Feed a log file to a stream: to a topic, or as text files for a file source."""
    lines = spark.read.text(path)
    if servers:
        lines.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        lines.repartition(files).write.mode("append").text(out)
