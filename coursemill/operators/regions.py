"""Visits by region of the address they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import region_field
from coursemill.operators.joins import ip_region_join

UNKNOWN = "0"  # fixed value: how region texts write a field they do not know
PROVINCE_FIELD = 2  # fixed value: country|0|province|city|isp


def with_province(rows: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    province = F.coalesce(region_field(F.col("region"), PROVINCE_FIELD), F.lit(UNKNOWN))
    return ip_region_join(rows, ranges, ip).withColumn("province", province).drop("region")


def ip_region_counts(rows: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Rows per province. Addresses are counted first, so a busy one is a single row in the join."""
    per_ip = rows.groupBy(ip).agg(F.count(F.lit(1)).alias("n"))
    return with_province(per_ip, ranges, ip).groupBy("province").agg(F.sum("n").alias("num"))


def topk_region(totals: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` provinces with most visits; ties in order of name."""
    return totals.orderBy(F.desc("num"), "province").limit(k)


def limit_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """The first ``n`` rows of a stated order, found without sorting everything."""
    return df.orderBy(*order).limit(n)
