"""The test tables seen as the tables of an online-learning warehouse.

Each function maps columns of whole test tables to the columns an operator
expects; ``CTE`` holds the same mapping as SQL for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursemill.functions.cleaning import mask_name, mask_phone, register_source_name

DT, DN = "20240101", "web"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One test table. Its schema is read once: inferring it costs a job each time."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: both engines then hand over the same value type."""
    cols = {n: F.col(n).cast("double") for n, t in df.dtypes if t.startswith("decimal")}
    return df.withColumns(cols) if cols else df


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def whole(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def month_of(c: str) -> Column:
    """``yyyyMM`` text without a date formatter, which costs more than the rest of a scan."""
    return text(F.year(c) * 100 + F.month(c))


def day_of(c: str) -> Column:
    return text(F.year(c) * 10000 + F.month(c) * 100 + F.day(c))


def dashed_day_of(c: str) -> Column:
    return text(F.col(c).cast("date"))


def geo(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


# --- members -------------------------------------------------------------------

def customer_geo(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(geo(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))


def member(spark: SparkSession, sf: str) -> DataFrame:
    key = text("c_custkey")
    return customer_geo(spark, sf).select(
        whole("c_custkey").alias("uid"), F.col("c_nationkey").alias("ad_id"),
        mask_name(F.col("c_name")).alias("fullname"), F.concat(F.lit("/icon/"), key).alias("iconurl"),
        F.concat(F.lit("2023-02-"), F.lpad(text(F.col("c_custkey") % 28 + 1), 2, "0")).alias("lastlogin"),
        F.concat(F.lit("mail-"), key).alias("mailaddr"), F.col("c_mktsegment").alias("memberlevel"),
        F.lit("******").alias("password"),
        mask_phone(F.concat(F.lit("138"), F.lpad(key, 8, "0"))).alias("phone"), key.alias("qq"),
        F.concat(F.lit("2022-"), F.lpad(text(F.col("c_custkey") % 12 + 1), 2, "0")).alias("register"),
        F.lit("2023-01-01").alias("regupdatetime"), F.concat(F.lit("unit-"), text("c_nationkey")).alias("unitname"),
        F.concat(F.lit("10.0.0."), text(F.col("c_custkey") % 256)).alias("userip"),
        F.lpad(text("c_nationkey"), 6, "0").alias("zipcode"),
        F.concat(F.lit("2023010"), text(F.col("c_custkey") % 3 + 1)).alias("dt"), F.col("r_name").alias("dn"))


def regtype(spark: SparkSession, sf: str) -> DataFrame:
    """One registration per customer, two for every tenth."""
    times = F.when(F.col("c_custkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    source = text(F.col("c_nationkey") % 6)
    return customer_geo(spark, sf).withColumn("k", F.explode(times)).select(
        whole("c_custkey").alias("uid"), F.concat(F.lit("app"), text("k")).alias("appkey"),
        F.concat(F.lit("/"), F.col("n_name"), F.lit("/"), text("k")).alias("appregurl"),
        F.concat(F.lit("b"), text("c_custkey")).alias("bdp_uuid"),
        F.concat(F.lit("2023-01-0"), text("k")).alias("reg_createtime"), F.lit("-").alias("isranreg"),
        source.alias("regsource"), register_source_name(source).alias("regsourcename"),
        F.col("n_regionkey").alias("siteid"), F.col("r_name").alias("dn"))


def ad(spark: SparkSession, sf: str) -> DataFrame:
    return geo(spark, sf).select(F.col("n_nationkey").alias("ad_id"), F.col("n_name").alias("adname"),
                                 F.col("r_name").alias("dn"))


def site(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("siteid"), F.col("r_name").alias("sitename"),
        F.concat(F.lit("http://"), F.lower("r_name")).alias("siteurl"), F.lit(0).alias("site_delete"),
        F.lit("2020-01-01").alias("site_createtime"), F.lit("admin").alias("site_creator"),
        F.col("r_name").alias("dn"))


def orders_geo(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").join(customer_geo(spark, sf), F.col("o_custkey") == F.col("c_custkey"))


def payment(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as payments; partly delivered ones carry no amount."""
    money = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(20,4)"))
    return orders_geo(spark, sf).select(
        whole("o_custkey").alias("uid"), money.alias("paymoney"),
        whole(F.substring("o_orderpriority", 1, 1)).alias("vip_id"),
        day_of("o_orderdate").alias("dt"), F.col("r_name").alias("dn"))


def vip(spark: SparkSession, sf: str) -> DataFrame:
    """Vip levels 1 to 4 of each site; the lowest priority has none."""
    day = dashed_day_of("o_orderdate")
    level = whole(F.substring("o_orderpriority", 1, 1))
    return (orders_geo(spark, sf).where(level < 5).groupBy(level.alias("vip_id"), F.col("r_name").alias("dn"))
            .agg(F.min("o_orderpriority").alias("vip_level"), F.min(day).alias("vip_start_time"),
                 F.max(day).alias("vip_end_time"), F.max(day).alias("vip_last_modify_time"))
            .select("vip_id", "vip_level", "vip_start_time", "vip_end_time", "vip_last_modify_time",
                    F.lit("99").alias("vip_max_free"), F.lit("1").alias("vip_min_free"),
                    text(F.col("vip_id") + 1).alias("vip_next_level"),
                    F.concat(F.lit("op"), text("vip_id")).alias("vip_operator"), "dn"))


# --- answers --------------------------------------------------------------------

def detail(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitems as graded answers: supplier = paper, order = user, part = question."""
    line, supplier = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        whole("l_orderkey").alias("userid"), whole("l_suppkey").alias("paperviewid"),
        F.col("s_name").alias("paperviewname"), F.concat(F.lit("c"), text("l_linenumber")).alias("chaptername"),
        F.concat(F.lit("p"), text("l_partkey")).alias("pointname"),
        (F.col("l_discount") * 1000 + 0.5).cast("int").cast("decimal(4,1)").alias("score"),
        whole("l_quantity").alias("spendtime"), whole("l_partkey").alias("questionid"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("user_question_answer"),
        month_of("l_shipdate").alias("dt"), F.col("l_returnflag").alias("dn"))


# --- events ---------------------------------------------------------------------

def millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def learn(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    ps = (e * 37) % 600
    return events.select(
        "event_id", F.col("user_id").alias("userid"), (F.col("user_id") % 5).alias("cwareid"),
        F.col("event_type").alias("videoid"), (e % 7).alias("chapterid"), (e % 4).alias("edutypeid"),
        F.col("event_type").alias("sourceType"), (e % 9).alias("subjectid"), millis().alias("ts"),
        (millis() + (e % 90 + 1) * 1000 + 500).alias("te"), ps.alias("ps"), (ps + 1 + (e * 13) % 60).alias("pe"))


def answers(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("userid"), (F.col("user_id") % 7).alias("courseid"),
        (F.col("event_id") % 3).alias("pointid"), text(F.col("event_id") % 40).alias("questionid"),
        F.when(F.col("value") > 10, "1").otherwise("0").alias("istrue"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("createtime"))


def pages(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    page = (F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3)
            .when(kind == "signup", 4).otherwise(5))
    k = F.get_json_object("props", "$.k").cast("int")
    num = (F.col("event_id") % 1000003 * 2654435) % 4294967296
    octets = [F.shiftright(num, s) % 256 for s in (24, 16, 8, 0)]
    return events.select(
        text("user_id").alias("uid"), text(k % 6).alias("last_page_id"), text(page).alias("page_id"),
        text(F.col("event_id") % 6).alias("next_page_id"), F.concat_ws(".", *[text(o) for o in octets]).alias("ip"))


def ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Each nation owns four fifths of a block of a hundred million addresses."""
    lo = F.col("n_nationkey").cast("bigint") * 100_000_000
    return geo(spark, sf).select(
        lo.alias("lo"), (lo + 79_999_999).alias("hi"),
        F.concat_ws("|", F.col("r_name"), F.lit("0"), F.col("n_name"), F.lit("0"), F.lit("isp")).alias("region"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return (spark.readStream.schema(events(spark, sf).schema)
            .option("pathGlobFilter", "events.parquet").parquet(sf))


# --- the same in SQL --------------------------------------------------------------

CTE = {
    "geo": "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey",
    "customer_geo": "SELECT * FROM customer JOIN geo ON c_nationkey = n_nationkey",
    "member": """
        SELECT CAST(c_custkey AS BIGINT) AS uid, c_nationkey AS ad_id, substr(c_name, 1, 1) || 'xx' AS fullname,
               '/icon/' || c_custkey AS iconurl, '2023-02-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS lastlogin,
               'mail-' || c_custkey AS mailaddr, c_mktsegment AS memberlevel, '******' AS password,
               '138*****' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) AS phone,
               CAST(c_custkey AS VARCHAR) AS qq,
               '2022-' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') AS register,
               '2023-01-01' AS regupdatetime, 'unit-' || c_nationkey AS unitname,
               '10.0.0.' || (c_custkey % 256) AS userip, lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS zipcode,
               '2023010' || (c_custkey % 3 + 1) AS dt, r_name AS dn
        FROM customer_geo""",
    "regtype": """
        SELECT CAST(c_custkey AS BIGINT) AS uid, 'app' || k AS appkey, '/' || n_name || '/' || k AS appregurl,
               'b' || c_custkey AS bdp_uuid, '2023-01-0' || k AS reg_createtime, '-' AS isranreg,
               CAST(c_nationkey % 6 AS VARCHAR) AS regsource,
               CASE c_nationkey % 6 WHEN 1 THEN 'PC' WHEN 2 THEN 'Mobile' WHEN 3 THEN 'App' WHEN 4 THEN 'WeChat'
                    ELSE 'other' END AS regsourcename,
               n_regionkey AS siteid, r_name AS dn
        FROM customer_geo, (VALUES (1), (2)) v(k) WHERE k = 1 OR c_custkey % 10 = 0""",
    "ad": "SELECT n_nationkey AS ad_id, n_name AS adname, r_name AS dn FROM geo",
    "site": """
        SELECT r_regionkey AS siteid, r_name AS sitename, 'http://' || lower(r_name) AS siteurl, 0 AS site_delete,
               '2020-01-01' AS site_createtime, 'admin' AS site_creator, r_name AS dn FROM region""",
    "orders_geo": "SELECT * FROM orders JOIN customer_geo ON o_custkey = c_custkey",
    "payment": """
        SELECT CAST(o_custkey AS BIGINT) AS uid,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(20,4)) END AS paymoney,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS vip_id,
               strftime(o_orderdate, '%Y%m%d') AS dt, r_name AS dn FROM orders_geo""",
    "vip": """
        SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS vip_id, min(o_orderpriority) AS vip_level,
               min(strftime(o_orderdate, '%Y-%m-%d')) AS vip_start_time,
               max(strftime(o_orderdate, '%Y-%m-%d')) AS vip_end_time,
               max(strftime(o_orderdate, '%Y-%m-%d')) AS vip_last_modify_time, '99' AS vip_max_free,
               '1' AS vip_min_free, CAST(CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + 1 AS VARCHAR) AS vip_next_level,
               'op' || substr(o_orderpriority, 1, 1) AS vip_operator, r_name AS dn
        FROM orders_geo WHERE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) < 5
        GROUP BY substr(o_orderpriority, 1, 1), r_name""",
    "detail": """
        SELECT CAST(l_orderkey AS BIGINT) AS userid, CAST(l_suppkey AS BIGINT) AS paperviewid,
               s_name AS paperviewname, 'c' || l_linenumber AS chaptername, 'p' || l_partkey AS pointname,
               CAST(round(l_discount * 1000) AS INTEGER) AS score, CAST(l_quantity AS BIGINT) AS spendtime,
               CAST(l_partkey AS BIGINT) AS questionid, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS answer,
               strftime(l_shipdate, '%Y%m') AS dt, l_returnflag AS dn
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "learn": """
        SELECT event_id, user_id AS userid, user_id % 5 AS cwareid, event_type AS videoid, event_id % 7 AS chapterid,
               event_id % 4 AS edutypeid, event_type AS "sourceType", event_id % 9 AS subjectid,
               event_id % 90 + 1 AS secs, epoch_us(ts) // 1000 AS ts, epoch_us(ts) // 1000 + (event_id % 90 + 1) * 1000 + 500 AS te,
               (event_id * 37) % 600 AS ps,
               (event_id * 37) % 600 + 1 + (event_id * 13) % 60 AS pe
        FROM events""",
    "answers": """
        SELECT user_id AS userid, user_id % 7 AS courseid, event_id % 3 AS pointid,
               CAST(event_id % 40 AS VARCHAR) AS questionid, CASE WHEN value > 10 THEN '1' ELSE '0' END AS istrue,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS createtime FROM events""",
    "pages": """
        SELECT CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 6 AS VARCHAR) AS last_page_id,
               CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'purchase' THEN '3'
                    WHEN 'signup' THEN '4' ELSE '5' END AS page_id,
               CAST(event_id % 6 AS VARCHAR) AS next_page_id, ((event_id % 1000003) * 2654435) % 4294967296 AS num
        FROM events""",
}

NEEDS = {
    "customer_geo": ["geo"], "member": ["customer_geo"], "regtype": ["customer_geo"], "ad": ["geo"],
    "orders_geo": ["customer_geo"], "payment": ["orders_geo"], "vip": ["orders_geo"],
}


def with_ctes(names: list[str], sql: str) -> str:
    """Prefix a query with the mappings it uses, in order of dependence."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)
    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in order) + "\n" + sql
