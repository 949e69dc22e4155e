"""Image files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Image files with their size and pixels; files that are no image are dropped."""
    df = spark.read.format("image").option("dropInvalid", True).load(path)
    return df.select("image.origin", "image.width", "image.height", "image.nChannels", "image.mode", "image.data")


def image_rows(images: DataFrame, dt: str, ts: str) -> DataFrame:
    """Add the day, the commit stamp and the record key to image rows."""
    return images.withColumns({"dt": F.lit(dt), "ts": F.lit(ts), "uuid": F.col("origin")})
