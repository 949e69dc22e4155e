"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes (shuffle partitions, memory) belong to the
# cluster and are left to it.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state outgrows the heap; only its changes go to the checkpoint after each batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "coursemill", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def enable_compression(spark: SparkSession, codec: str = "snappy") -> None:
    """Compress every file written later in this session."""
    spark.conf.set("spark.sql.parquet.compression.codec", codec)
    spark.conf.set("spark.sql.orc.compression.codec", codec)


def enable_dynamic_partitions(spark: SparkSession) -> None:
    """Overwrite only the partitions a write touches."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a
    local session may fall back on the machine's temporary folder: elsewhere
    that would not survive the loss of an executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="coursemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/coursemill/{label}-{uuid.uuid4().hex}"
