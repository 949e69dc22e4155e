"""Member wide table and member reports."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators import member as M
from coursemill.operators import metrics
from coursemill.operators.metrics import MEMBER_COUNTS, member_count
from coursemill.operators.metrics import top3_payers as _top3
from coursemill.registry import inputs as I

MEMBER_INPUTS = ["member", "regtype", "ad", "site", "payment", "vip"]


def _inputs(spark: SparkSession, sf: str) -> list[DataFrame]:
    member, reg, ad, site, pay, vip = (getattr(I, n)(spark, sf) for n in MEMBER_INPUTS)
    return [member, reg, ad, site, pay.drop("dt"), vip]


def member_wide_join(spark: SparkSession, sf: str) -> DataFrame:
    return I.plain(M.member_wide_join(*_inputs(spark, sf)))


def member_wide(spark: SparkSession, sf: str) -> DataFrame:
    return M.member_wide_agg(*_inputs(spark, sf))


def _shown(wide: DataFrame) -> DataFrame:
    return wide.withColumns({"paymoney": F.col("paymoney").cast("double"), "vip_id": F.col("vip_id").cast("string")})


def member_wide_agg(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(member_wide(spark, sf))


def member_wide_agg_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(M.member_wide_agg(*_inputs(spark, sf), zero=True))


def count_query(by: str, spark: SparkSession, sf: str) -> DataFrame:
    return member_count(member_wide(spark, sf), by)


def member_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.member_counts(member_wide(spark, sf))


def top3_payers(spark: SparkSession, sf: str) -> DataFrame:
    return I.plain(_top3(member_wide(spark, sf)))


QUERIES = {
    "member_wide_join": member_wide_join, "member_wide_agg": member_wide_agg,
    "member_wide_agg_zero": member_wide_agg_zero,
    **{key: partial(count_query, by) for key, by in MEMBER_COUNTS.items()},
    "member_counts": member_counts, "top3_payers": top3_payers,
}

_JOINS = """
    FROM member m
    LEFT JOIN regtype r ON r.uid = m.uid AND r.dn = m.dn
    LEFT JOIN ad a ON a.ad_id = m.ad_id AND a.dn = m.dn
    LEFT JOIN site s ON s.siteid = r.siteid AND s.dn = m.dn
    LEFT JOIN payment p ON p.uid = m.uid AND p.dn = m.dn
    LEFT JOIN vip v ON v.vip_id = p.vip_id AND v.dn = m.dn"""
_REG = [c for c in M.REGTYPE] + M.SITE


def _wide_sql(zero: bool) -> str:
    cols = ["m.uid"] + [f"min(m.{c}) AS {c}" for c in M.MEMBER] + ["min(a.adname) AS adname"]
    cols += [f"arg_min({'r' if c in M.REGTYPE else 's'}.{c}, r.reg_createtime) AS {c}" for c in _REG]
    cols += [f"CAST(arg_min(v.{c}, v.vip_id) AS VARCHAR) AS {c}" for c in M.VIP_FIRST]
    cols += ["max(v.vip_level) AS vip_level", "min(v.vip_start_time) AS vip_start_time",
             "max(v.vip_end_time) AS vip_end_time", "max(v.vip_last_modify_time) AS vip_last_modify_time"]
    if zero:
        cols += ["arg_min(v.vip_next_level, v.vip_id) AS vip_next_level",
                 "CAST(coalesce(sum(p.paymoney), 0) AS DOUBLE) AS paymoney"]
    else:
        cols += ["max(v.vip_next_level) AS vip_next_level", "CAST(sum(p.paymoney) AS DOUBLE) AS paymoney"]
    return f"SELECT {', '.join(cols)}, m.dt, m.dn {_JOINS} GROUP BY m.uid, m.dn, m.dt"


def _count_sql(by: str) -> str:
    return I.with_ctes(MEMBER_INPUTS, f"""
        SELECT {by}, count(*) AS num, dt, dn FROM ({_wide_sql(False)}) GROUP BY {by}, dt, dn""")


_PLAIN = ["m.uid", *[f"m.{c}" for c in M.MEMBER], "CAST(p.paymoney AS DOUBLE) AS paymoney",
          *[f"r.{c}" for c in M.REGTYPE], "a.adname", *[f"s.{c}" for c in M.SITE], "p.vip_id",
          *[f"v.{c}" for c in M.VIP], "m.dt", "m.dn"]

SQL = {
    "member_wide_join": I.with_ctes(MEMBER_INPUTS, f"SELECT {', '.join(_PLAIN)} {_JOINS}"),
    "member_wide_agg": I.with_ctes(MEMBER_INPUTS, _wide_sql(False)),
    "member_wide_agg_zero": I.with_ctes(MEMBER_INPUTS, _wide_sql(True)),
    **{key: _count_sql(by) for key, by in MEMBER_COUNTS.items()},
    "member_counts": I.with_ctes(MEMBER_INPUTS, f"SELECT * FROM (WITH wide AS ({_wide_sql(False)}) " + " UNION ALL ".join(
        f"SELECT '{key}' AS report, CAST({by} AS VARCHAR) AS value, count(*) AS num, dt, dn FROM wide GROUP BY {by}, dt, dn"
        for key, by in MEMBER_COUNTS.items()) + ")"),
    "top3_payers": I.with_ctes(MEMBER_INPUTS, f"""
        SELECT * FROM (
            SELECT uid, memberlevel, register, appregurl, regsourcename, adname, sitename, vip_level, paymoney,
                   CAST(row_number() OVER (PARTITION BY dt, dn, memberlevel
                                           ORDER BY paymoney DESC NULLS LAST, uid) AS INTEGER) AS rownum, dt, dn
            FROM ({_wide_sql(False)})) WHERE rownum <= 3"""),
}
