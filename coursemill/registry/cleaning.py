"""Log cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions import cleaning as C
from coursemill.functions import scalars as S
from coursemill.operators.metrics import filter_after_project
from coursemill.operators.versioned import derive_partition_path
from coursemill.registry.inputs import plain, table, text
from coursemill.sources.lines import drop_bad_json, json_lines_to_table, tsv_fields
from coursemill.sources.specs import spec
from coursemill.sources.tables import scan_table

BROKEN = ["", "   ", "[1,2]", '"x"', "null", "{bad"]


def _with_broken(df: DataFrame, every: str) -> DataFrame:
    """Lines in ``value``, with broken ones added at every tenth row."""
    more = F.array(F.col("value"), *[F.lit(b) for b in BROKEN])
    return df.select(F.explode(F.when(F.col(every) % 10 == 0, more).otherwise(F.array("value"))).alias("value"))


def member_lines(spark: SparkSession, sf: str) -> DataFrame:
    key = text("c_custkey")
    fields = F.struct(
        F.col("c_custkey").alias("uid"), text("c_nationkey").alias("ad_id"), F.col("c_name").alias("fullname"),
        F.concat(F.lit("/icon/"), key).alias("iconurl"), F.col("c_mktsegment").alias("memberlevel"),
        F.concat(F.lit("138"), F.lpad(key, 8, "0")).alias("phone"), F.lit("secret").alias("password"),
        text(F.col("c_acctbal").cast("decimal(12,2)")).alias("paymoney"), F.lit("20240101").alias("dt"),
        F.lit("web").alias("dn"))
    return _with_broken(table(spark, sf, "customer").withColumn("value", F.to_json(fields)), "c_custkey")


def etl_member(spark: SparkSession, sf: str) -> DataFrame:
    return json_lines_to_table(member_lines(spark, sf), spec("dwd_member")).select(
        "uid", "ad_id", "fullname", "iconurl", "memberlevel", "password", "paymoney", "phone", "qq", "dt", "dn")


def etl_drop_bad_json(spark: SparkSession, sf: str) -> DataFrame:
    return drop_bad_json(member_lines(spark, sf), ["uid", "fullname"]).select(
        F.col("uid").cast("bigint").alias("uid"), "fullname")


def etl_int_or_zero(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), text("p_size")
    kind = key % 6
    value = (F.when(kind == 0, F.concat(F.lit('"n":'), size)).when(kind == 1, F.concat(F.lit('"n":"'), size, F.lit('"')))
             .when(kind == 2, F.concat(F.lit('"n":'), size, F.lit(".7"))).when(kind == 3, F.lit('"n":"abc"'))
             .when(kind == 4, F.lit('"n":null')).otherwise(F.lit('"m":1')))
    lines = table(spark, sf, "part").select(F.concat(F.lit('{"id":'), text(key), F.lit(","), value, F.lit("}")).alias("value"))
    return drop_bad_json(lines, ["id", "n"]).select(
        F.col("id").cast("bigint").alias("id"), C.int_or_zero(F.col("n")).alias("n"))


def etl_string_or_empty(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    value = F.to_json(F.struct(text(key).alias("uid"), F.when(key % 2 == 0, text("c_nationkey")).alias("page_id"),
                               F.when(key % 3 == 0, F.lit("10.0.0.1")).alias("ip")))
    return json_lines_to_table(table(spark, sf, "customer").select(value.alias("value")), spec("page_event"))


def etl_decimal_half_up(spark: SparkSession, sf: str) -> DataFrame:
    hundredths = F.col("p_partkey") % 10000
    score = F.concat(text(F.floor(hundredths / 100)), F.lit("."), F.lpad(text(hundredths % 100), 2, "0"))
    value = F.to_json(F.struct(F.col("p_partkey").alias("id"), score.alias("score")))
    rows = drop_bad_json(table(spark, sf, "part").select(value.alias("value")), ["id", "score"])
    return plain(rows.select(F.col("id").cast("bigint").alias("id"), C.decimal_half_up(F.col("score")).alias("score")))


def etl_code_map(spark: SparkSession, sf: str) -> DataFrame:
    code = F.when(F.col("c_custkey") % 11 != 0, text(F.col("c_nationkey") % 6))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("uid"), C.register_source_name(code).alias("regsourcename"), C.app_name(code).alias("app"))


def etl_tsv_fields(spark: SparkSession, sf: str) -> DataFrame:
    key, name = text("c_custkey"), F.col("c_name")
    kind = F.col("c_custkey") % 6
    line = (F.when(kind == 0, F.concat_ws("\t", key, name)).when(kind == 1, F.concat_ws("\t", key, name, F.lit("a")))
            .when(kind == 2, F.concat_ws("\t", key, name, F.lit("b"), F.lit("")))
            .when(kind == 3, F.concat_ws("\t", key, name, F.lit("c"), F.lit("d")))
            .when(kind == 4, F.concat_ws("\t", key, F.lit(""), F.lit("e")))
            .otherwise(F.concat_ws("\t", key, name, F.lit(""))))
    return tsv_fields(table(spark, sf, "customer").select(line.alias("value")), ["userid", "name", "mark"])


def scan_project_partition(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("dt", F.date_format("o_orderdate", "yyyy"))
    return plain(scan_table(orders, "o_orderkey>orderid o_custkey>uid o_totalprice>paymoney::decimal(20,4) dt", "1997"))


def filter_score_range(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").withColumn("score", F.round(F.col("l_discount") * 1000).cast("int"))
    return filter_after_project(line, ["l_orderkey", "l_linenumber", "l_partkey"], F.col("score").between(0, 60))


def partition_paths(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("uid"), F.date_format("o_orderdate", "yyyyMMdd").alias("dt"),
        F.col("o_orderstatus").alias("dn"))
    return derive_partition_path(orders, "20240101000000")


def dt_to_date(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", S.dt_to_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"))


def epoch_to_day(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", S.epoch_to_day(ms).alias("day"))


def strip_digits_dots(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat(text("p_partkey"), F.lit("."), F.col("p_name"), F.lit("."), text("p_size"))
    return table(spark, sf, "part").select("p_partkey", S.strip_digits_dots(line).alias("bare"))


QUERIES = {
    "etl_member": etl_member, "etl_drop_bad_json": etl_drop_bad_json, "etl_int_or_zero": etl_int_or_zero,
    "etl_string_or_empty": etl_string_or_empty, "etl_decimal_half_up": etl_decimal_half_up,
    "etl_code_map": etl_code_map, "etl_tsv_fields": etl_tsv_fields,
    "scan_project_partition": scan_project_partition, "filter_score_range": filter_score_range,
    "derive_partition_path": partition_paths, "dt_to_date": dt_to_date, "epoch_to_day": epoch_to_day,
    "strip_digits_dots": strip_digits_dots,
}

SQL = {
    "etl_member": """
        SELECT CAST(c_custkey AS BIGINT) AS uid, CAST(c_nationkey AS BIGINT) AS ad_id, substr(c_name, 1, 1) || 'xx' AS fullname,
               '/icon/' || c_custkey AS iconurl, c_mktsegment AS memberlevel, '******' AS password,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS paymoney,
               '138*****' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) AS phone,
               CAST(NULL AS VARCHAR) AS qq, '20240101' AS dt, 'web' AS dn FROM customer""",
    "etl_drop_bad_json": "SELECT c_custkey AS uid, c_name AS fullname FROM customer",
    "etl_int_or_zero": """
        SELECT p_partkey AS id, CAST(CASE WHEN p_partkey % 6 < 3 THEN p_size ELSE 0 END AS BIGINT) AS n FROM part""",
    "etl_string_or_empty": """
        SELECT CAST(c_custkey AS VARCHAR) AS uid, '' AS app_id, '' AS device_id,
               CASE WHEN c_custkey % 3 = 0 THEN '10.0.0.1' ELSE '' END AS ip, '' AS last_page_id,
               CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS page_id,
               '' AS next_page_id FROM customer""",
    "etl_decimal_half_up": """
        SELECT p_partkey AS id, CAST((p_partkey % 10000 + 5) // 10 AS DOUBLE) / 10 AS score FROM part""",
    "etl_code_map": """
        SELECT c_custkey AS uid,
               CASE WHEN c_custkey % 11 = 0 THEN 'other' ELSE CASE c_nationkey % 6 WHEN 1 THEN 'PC'
                    WHEN 2 THEN 'Mobile' WHEN 3 THEN 'App' WHEN 4 THEN 'WeChat' ELSE 'other' END END AS regsourcename,
               CASE WHEN c_custkey % 11 = 0 THEN 'Other' WHEN c_nationkey % 6 = 1 THEN 'PC'
                    WHEN c_nationkey % 6 = 2 THEN 'APP' ELSE 'Other' END AS app FROM customer""",
    "etl_tsv_fields": """
        SELECT CAST(c_custkey AS VARCHAR) AS userid, CASE c_custkey % 6 WHEN 4 THEN '' ELSE c_name END AS name,
               CASE c_custkey % 6 WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'e' END AS mark
        FROM customer WHERE c_custkey % 6 IN (1, 2, 4)""",
    "scan_project_partition": """
        SELECT o_orderkey AS orderid, o_custkey AS uid, CAST(CAST(o_totalprice AS DECIMAL(20,4)) AS DOUBLE) AS paymoney,
               strftime(o_orderdate, '%Y') AS dt FROM orders WHERE strftime(o_orderdate, '%Y') = '1997'""",
    "filter_score_range": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE CAST(round(l_discount * 1000) AS INTEGER) BETWEEN 0 AND 60""",
    "derive_partition_path": """
        SELECT o_orderkey AS uid, strftime(o_orderdate, '%Y%m%d') AS dt, o_orderstatus AS dn, '20240101000000' AS ts,
               o_orderkey AS uuid, strftime(o_orderdate, '%Y%m%d') || '/' || o_orderstatus AS partitionpath FROM orders""",
    "dt_to_date": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
    "epoch_to_day": "SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events",
    "strip_digits_dots": "SELECT p_partkey, p_name || CAST(p_size AS VARCHAR) AS bare FROM part",
}
