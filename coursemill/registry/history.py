"""Payment history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators import history as H
from coursemill.operators.sinks import replace_table
from coursemill.registry import inputs as I
from coursemill.session import scratch_dir

LATE_DAY = "1997-06-15"


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return H.daily_payment_delta(I.payment(spark, sf), I.vip(spark, sf))


def scd2_daily_delta(spark: SparkSession, sf: str) -> DataFrame:
    return I.plain(daily(spark, sf))


def scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A stored history of all days but one, and then the missing day arrives."""
    days, path = daily(spark, sf), scratch_dir(spark, "history")
    replace_table(H.build_history(days.where(F.col("start_time") != LATE_DAY)), path)
    return I.plain(H.scd2_merge(spark.read.parquet(path), days.where(F.col("start_time") == LATE_DAY), LATE_DAY))


QUERIES = {"scd2_daily_delta": scd2_daily_delta, "scd2_merge": scd2_merge}

_DAYS = """
    SELECT uid, dn, substr(p.dt, 1, 4) || '-' || substr(p.dt, 5, 2) || '-' || substr(p.dt, 7, 2) AS start_time,
           sum(paymoney) AS paid, max(vip_level) AS vip_level
    FROM payment p JOIN vip v USING (vip_id, dn) GROUP BY uid, dn, p.dt"""
SQL = {
    "scd2_daily_delta": I.with_ctes(["payment", "vip"], f"""
        SELECT uid, CAST(paid AS DOUBLE) AS paymoney, vip_level, start_time, '9999-12-31' AS end_time, dn
        FROM ({_DAYS})"""),
    "scd2_merge": I.with_ctes(["payment", "vip"], f"""
        SELECT uid, CAST(sum(coalesce(paid, 0)) OVER w AS DOUBLE) AS paymoney, vip_level, start_time,
               coalesce(lead(start_time) OVER w, '9999-12-31') AS end_time, dn
        FROM ({_DAYS}) WINDOW w AS (PARTITION BY uid, dn ORDER BY start_time)"""),
}
