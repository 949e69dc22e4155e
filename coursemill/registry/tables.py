"""Keyed tables, versioned tables and sinks, each written and read back."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators import keyed as K
from coursemill.operators import sinks as W
from coursemill.operators import versioned as V
from coursemill.registry.inputs import day_of, table
from coursemill.session import scratch_dir

NEW_IDS = 1_000_000_000_000


# --- keyed tables ---------------------------------------------------------------

def _accounts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("count"))


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    """The customers of five nations, renamed, and as many rows with ids not seen before."""
    some = table(spark, sf, "customer").where("c_nationkey < 5")
    both = F.explode(F.array(F.lit(0).cast("bigint"), F.lit(NEW_IDS).cast("bigint")))
    return some.select("c_custkey", both.alias("shift")).select(
        (F.col("c_custkey") + F.col("shift")).alias("id"),
        F.concat(F.lit("new-"), F.col("c_custkey").cast("string")).alias("name"), F.lit(7).cast("bigint").alias("count"))


def keyed_query(kind: str, spark: SparkSession, sf: str) -> DataFrame:
    base, rows, keys = _accounts(spark, sf), _changes(spark, sf), ["id"]
    path = scratch_dir(spark, kind)
    K.keyed_create(spark, path, base.schema)
    K.apply_insert(spark, path, base, keys, base.schema)
    if kind == "keyed_add":
        K.apply_add(spark, path, rows, keys, ["count"], base.schema, 1)
        K.apply_add(spark, path, rows, keys, ["count"], base.schema, 1)  # repeated batch: no effect
    else:
        change = {"keyed_insert": K.apply_insert, "keyed_update": K.apply_update, "keyed_delete": K.apply_delete,
                  "keyed_upsert": K.apply_upsert}[kind]
        change(spark, path, rows, keys, base.schema)
    return K.read_keyed(spark, path, keys, base.schema)


# --- versioned tables -------------------------------------------------------------

def _lake(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Orders in three commits by date; the last one renames its rows."""
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("uid"), day_of("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("orderid"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("dn"))
    cuts = [F.col("ts") < "19950101", F.col("ts").between("19950101", "19979999"), F.col("ts") >= "19980101"]
    commits = [rows.where(c) for c in cuts]
    commits[2] = V.typed_map(commits[2], "name", F.lit("testName"))
    return commits


KEY, PRE = ["uid"], "ts"


def _committed(spark: SparkSession, sf: str, label: str) -> str:
    path = scratch_dir(spark, label)
    first, second, third = _lake(spark, sf)
    V.versioned_insert(first, path, KEY, PRE, 1)
    V.versioned_upsert(second, path, KEY, PRE, 2)
    V.versioned_upsert(third, path, KEY, PRE, 3)
    return path


def versioned_insert(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "versioned_insert")
    first, second, third = _lake(spark, sf)
    V.versioned_insert(first.union(second).union(third), path, KEY, PRE, 1)
    return V.read_commits(spark, path).drop(V.COMMIT)


def versioned_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return V.read_snapshot(spark, _committed(spark, sf, "snapshot"), KEY, PRE)


def versioned_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return V.read_incremental(spark, _committed(spark, sf, "incremental"), KEY, PRE, 1)


def versioned_point_in_time(spark: SparkSession, sf: str) -> DataFrame:
    return V.read_between(spark, _committed(spark, sf, "between"), KEY, PRE, 1, 2)


def _cow(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "cow")
    commits = _lake(spark, sf)
    for i, rows in enumerate(commits, 1):
        V.cow_upsert(spark, rows, path, KEY, PRE, "dn", i)
    return V.read_cow(spark, path, commits[0].schema.add(V.COMMIT, "long"))


def versioned_cow(spark: SparkSession, sf: str) -> DataFrame:
    return _cow(spark, sf)


def versioned_move_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and different keys per partition: equal, since no key stays in two partitions."""
    return _cow(spark, sf).groupBy("dn").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("uid").alias("uids"))


# --- sinks -----------------------------------------------------------------------

def _by_year(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").cast("string").alias("dt"), F.col("o_orderstatus").alias("dn"))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("o_orderkey bigint, o_totalprice double, dt string, dn string").parquet(path)


def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = scratch_dir(spark, "append"), W.spread_for_partitions(_by_year(spark, sf), ["dt", "dn"])
    W.write_append(rows.where("o_totalprice < 200000"), path)
    W.write_append(rows.where("o_totalprice >= 200000"), path)
    return _read(spark, path)


def sink_dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = scratch_dir(spark, "overwrite"), W.spread_for_partitions(_by_year(spark, sf), ["dt", "dn"])
    W.write_overwrite(rows, path)
    W.write_overwrite(rows.where("dt = '1997'").withColumn("o_totalprice", F.lit(0.0)), path)
    return _read(spark, path)


QUERIES = {
    **{k: partial(keyed_query, k) for k in ("keyed_insert", "keyed_update", "keyed_delete", "keyed_upsert", "keyed_add")},
    "versioned_insert": versioned_insert, "versioned_snapshot": versioned_snapshot,
    "versioned_incremental": versioned_incremental, "versioned_point_in_time": versioned_point_in_time,
    "versioned_cow": versioned_cow, "versioned_move_partition": versioned_move_partition,
    "sink_append": sink_append, "sink_dynamic_overwrite": sink_dynamic_overwrite,
}

_KEYED = f"""
    WITH base AS (SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS count FROM customer),
         chg AS (SELECT c_custkey AS id, 'new-' || c_custkey AS name, CAST(7 AS BIGINT) AS count FROM customer
                  WHERE c_nationkey < 5),
         more AS (SELECT id + {NEW_IDS} AS id, name, count FROM chg)
"""
_REST = "SELECT * FROM base WHERE id NOT IN (SELECT id FROM chg)"
_LAKE = """
    WITH lake AS (SELECT o_custkey AS uid, strftime(o_orderdate, '%Y%m%d') AS ts, o_orderkey AS orderid,
                         CASE WHEN strftime(o_orderdate, '%Y') >= '1998' THEN 'testName' ELSE o_orderpriority END AS name,
                         o_orderstatus AS dn,
                         CAST(CASE WHEN strftime(o_orderdate, '%Y') < '1995' THEN 1
                                   WHEN strftime(o_orderdate, '%Y') < '1998' THEN 2 ELSE 3 END AS BIGINT) AS _commit_ts
                  FROM orders)
"""


def _latest(where: str, cols: str = "uid, ts, orderid, name, dn, _commit_ts", after: int = 0) -> str:
    return _LAKE + f"""
        SELECT {cols} FROM (
            SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, _commit_ts DESC, orderid DESC) AS rn
            FROM lake WHERE {where}) WHERE rn = 1 AND _commit_ts > {after}"""


_YEARS = "SELECT o_orderkey, {price} AS o_totalprice, strftime(o_orderdate, '%Y') AS dt, o_orderstatus AS dn FROM orders"
SQL = {
    "keyed_insert": _KEYED + "SELECT * FROM base UNION ALL SELECT * FROM more",
    "keyed_update": _KEYED + f"{_REST} UNION ALL SELECT * FROM chg",
    "keyed_delete": _KEYED + _REST,
    "keyed_upsert": _KEYED + f"{_REST} UNION ALL SELECT * FROM chg UNION ALL SELECT * FROM more",
    "keyed_add": _KEYED + f"""{_REST} UNION ALL
        SELECT id, s.name, b.count + s.count AS count FROM chg s JOIN base b USING (id) UNION ALL SELECT * FROM more""",
    "versioned_insert": _latest("true", "uid, ts, orderid, name, dn"),
    "versioned_snapshot": _latest("true"),
    "versioned_incremental": _latest("true", after=1),
    "versioned_point_in_time": _latest("_commit_ts <= 2", after=1),
    "versioned_cow": _latest("true"),
    "versioned_move_partition": f"SELECT dn, count(*) AS n, count(DISTINCT uid) AS uids FROM ({_latest('true')}) GROUP BY dn",
    "sink_append": _YEARS.format(price="o_totalprice"),
    "sink_dynamic_overwrite": _YEARS.format(
        price="CASE WHEN strftime(o_orderdate, '%Y') = '1997' THEN CAST(0 AS DOUBLE) ELSE o_totalprice END"),
}
