"""Course sales: one join, four physical forms."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators import joins as J
from coursemill.operators.sinks import split_hot, write_bucketed
from coursemill.registry.inputs import DN, DT, dashed_day_of, table
from coursemill.session import scratch_dir


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Course = part of a size below 25, cart = lineitem, payment = finished order."""
    day = {"dt": F.lit(DT), "dn": F.lit(DN)}
    sale = table(spark, sf, "part").where("p_size < 25").select(
        F.col("p_partkey").alias("courseid"), F.col("p_name").alias("coursename"), F.col("p_type").alias("status"),
        F.col("p_retailprice").alias("money")).withColumns(day)
    cart = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("courseid"), F.col("l_orderkey").alias("orderid"),
        F.lit("in the cart").alias("coursename"), F.col("l_discount").alias("discount"),
        F.col("l_extendedprice").alias("sellmoney"),
        dashed_day_of("l_shipdate").alias("createtime")).withColumns(day)
    pay = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("orderid"), F.lit(0.0).alias("discount"), F.col("o_totalprice").alias("paymoney"),
        dashed_day_of("o_orderdate").alias("createtime")).withColumns(day)
    return sale, cart, pay


def cart_join_plain(spark: SparkSession, sf: str) -> DataFrame:
    return J.cart_join(*_inputs(spark, sf))


def cart_join_salted(spark: SparkSession, sf: str) -> DataFrame:
    return J.cart_join_salted(*_inputs(spark, sf))


def cart_join_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    return J.cart_join_broadcast(*_inputs(spark, sf))


def bucketed_tables(spark: SparkSession, sf: str, min_rows: int = J.HOT_ROWS) -> list[DataFrame]:
    """Carts and payments bucketed by order, and the carts of orders too large for a bucket."""
    _, cart, pay = _inputs(spark, sf)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cart, hot = split_hot(cart, "orderid", min_rows)
    frames = []
    for kind, df in (("cart", cart), ("pay", pay)):
        name = f"coursemill_{kind}_{uuid4().hex}"
        write_bucketed(df, name, scratch_dir(spark, name), "orderid", buckets)
        frames.append(spark.table(name).withColumns({c: F.col(c).cast("string") for c in ("dt", "dn")}))
    return [*frames, hot]


def cart_join_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    sale = _inputs(spark, sf)[0]
    return J.cart_join_bucketed(sale, *bucketed_tables(spark, sf))


QUERIES = {f.__name__: f for f in (cart_join_plain, cart_join_salted, cart_join_broadcast, cart_join_bucketed)}

_SQL = """
    SELECT l_partkey AS courseid, p_name AS coursename, p_type AS status, p_retailprice AS money, l_orderkey AS orderid,
           l_discount AS cart_discount, l_extendedprice AS sellmoney, strftime(l_shipdate, '%Y-%m-%d') AS cart_createtime,
           CASE WHEN o_orderkey IS NOT NULL THEN CAST(0 AS DOUBLE) END AS pay_discount, o_totalprice AS paymoney,
           strftime(o_orderdate, '%Y-%m-%d') AS pay_createtime, '20240101' AS dt, 'web' AS dn
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 25) ON p_partkey = l_partkey
         LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = l_orderkey"""
SQL = {key: _SQL for key in QUERIES}
