"""Page visits: transitions, funnel, regions; small table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators import pages as P
from coursemill.operators import regions as R
from coursemill.operators import sketch as B
from coursemill.operators.joins import state_full_outer_merge
from coursemill.registry import inputs as I
from coursemill.registry.inputs import table


def visits(spark: SparkSession, sf: str) -> DataFrame:
    return I.pages(I.events(spark, sf))


def page_transition_count(spark: SparkSession, sf: str) -> DataFrame:
    return P.page_transition_count(visits(spark, sf))


def page_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return P.page_funnel(P.page_visit_total(P.page_transition_count(visits(spark, sf))))


def ip_region_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.ip_region_counts(visits(spark, sf), I.ranges(spark, sf))


def topk_region(spark: SparkSession, sf: str) -> DataFrame:
    return R.topk_region(ip_region_counts(spark, sf))


def state_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Stored totals per user from the first half of January, a batch from the rest."""
    rows, cut = I.events(spark, sf), F.lit("2024-01-16").cast("timestamp_ntz")
    halves = [rows.where(when).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("num"))
              for when in (F.col("ts") < cut, F.col("ts") >= cut)]
    return state_full_outer_merge(halves[0], halves[1], ["user_id", "event_type"], ["num"])


def limit_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return R.limit_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 100,
                        [F.desc("o_totalprice"), "o_orderkey"])


def bloom_membership(spark: SparkSession, sf: str) -> DataFrame:
    """Orders probed against the customers of one segment.

    One row says how far the filter kept its promise: members and others among
    the orders, members it missed (none) and whether it let few others through.
    Orders are counted per customer first, so a busy customer is probed once.
    """
    members = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("key"))
    size = max(1, members.count())
    bloom = B.bloom_build(members, "key", size)
    per_key = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = B.bloom_membership(per_key, "key", bloom, size).join(members.withColumn("member", F.lit(True)), "key", "left")
    n, is_member = F.col("n"), F.coalesce("member", F.lit(False))
    out = known.agg(
        F.sum(F.when(is_member, n).otherwise(0)).alias("members"),
        F.sum(F.when(~is_member, n).otherwise(0)).alias("others"),
        F.sum(F.when(is_member & ~F.col("maybe"), n).otherwise(0)).alias("false_negatives"),
        F.sum(F.when(~is_member & F.col("maybe"), n).otherwise(0)).alias("_fp"))
    return out.select("members", "others", "false_negatives",
                      (F.col("_fp") <= F.col("others") * 0.05).alias("few_false_positives"))


QUERIES = {
    "page_transition_count": page_transition_count, "page_funnel": page_funnel, "ip_region_counts": ip_region_counts,
    "topk_region": topk_region, "state_full_outer_merge": state_merge, "limit_ordered": limit_ordered,
    "bloom_membership": bloom_membership,
}

TRANSITION_SQL = I.with_ctes(["pages"], """
    SELECT last_page_id, page_id, next_page_id, count(*) AS num FROM pages
    GROUP BY last_page_id, page_id, next_page_id""")
FUNNEL_SQL = I.with_ctes(["pages"], """
    SELECT CAST(p AS INTEGER) AS page_id, num,
           CASE WHEN p = 1 THEN '100%' WHEN before = 0 THEN '0%'
                ELSE CAST(CAST(round_even(CAST(num AS DOUBLE) / before * 100, 0) AS INTEGER) AS VARCHAR) || '%' END AS jump_rate
    FROM (SELECT p, num, lag(num) OVER (ORDER BY p) AS before FROM (
        SELECT p, count(page_id) AS num FROM (VALUES (1), (2), (3)) v(p)
        LEFT JOIN pages ON page_id = CAST(p AS VARCHAR) GROUP BY p))""")
REGION_SQL = """
    SELECT coalesce(n_name, '0') AS province, count(*) AS num
    FROM pages LEFT JOIN geo ON num BETWEEN n_nationkey * 100000000::BIGINT AND n_nationkey * 100000000::BIGINT + 79999999
    GROUP BY 1"""

SQL = {
    "page_transition_count": TRANSITION_SQL,
    "page_funnel": FUNNEL_SQL,
    "ip_region_counts": I.with_ctes(["geo", "pages"], REGION_SQL),
    "topk_region": I.with_ctes(["geo", "pages"], f"SELECT * FROM ({REGION_SQL}) ORDER BY num DESC, province LIMIT 3"),
    "state_full_outer_merge": "SELECT user_id, event_type, count(*) AS num FROM events GROUP BY user_id, event_type",
    "limit_ordered": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "bloom_membership": """
        SELECT count(*) FILTER (c_mktsegment = 'BUILDING') AS members,
               count(*) FILTER (c_mktsegment <> 'BUILDING') AS others, CAST(0 AS BIGINT) AS false_negatives,
               true AS few_false_positives
        FROM orders JOIN customer ON c_custkey = o_custkey""",
}
