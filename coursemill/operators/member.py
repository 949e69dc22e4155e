"""Member wide table: joins and one row per member."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators.joins import HOT_ROWS, SALT_COPIES, _present, hot_left_join

# fixed values: columns of the member wide table, by where they come from
MEMBER = ("ad_id fullname iconurl lastlogin mailaddr memberlevel password phone qq register regupdatetime unitname "
          "userip zipcode").split()
REGTYPE = "appkey appregurl bdp_uuid reg_createtime isranreg regsource regsourcename siteid".split()
AD = ["adname"]
SITE = "sitename siteurl site_delete site_createtime site_creator".split()
VIP_FIRST = "vip_id vip_max_free vip_min_free vip_operator".split()
VIP = ("vip_level vip_start_time vip_end_time vip_last_modify_time vip_max_free vip_min_free vip_next_level "
       "vip_operator").split()
DWS_MEMBER = ("uid ad_id fullname iconurl lastlogin mailaddr memberlevel password paymoney phone qq register "
              "regupdatetime unitname userip zipcode appkey appregurl bdp_uuid reg_createtime isranreg regsource "
              "regsourcename adname siteid sitename siteurl site_delete site_createtime site_creator vip_id "
              "vip_level vip_start_time vip_end_time vip_last_modify_time vip_max_free vip_min_free "
              "vip_next_level vip_operator dt dn").split()
MONEY = "decimal(20,4)"


def member_wide_join(member: DataFrame, regtype: DataFrame, ad: DataFrame, site: DataFrame, payment: DataFrame,
                     vip: DataFrame, n: int = SALT_COPIES, min_rows: int = HOT_ROWS) -> DataFrame:
    """Members with registration, ad, site, payments and vip level: one row per match.

    Registrations and payments grow with the logs and may pile up on one
    member, so those two joins spread hot members; ads, sites and vip levels
    are lookups, broadcast by Spark while their size permits.
    """
    wide = hot_left_join(member, regtype, ["uid", "dn"], n, min_rows)
    wide = wide.join(ad, ["ad_id", "dn"], "left").join(site, ["siteid", "dn"], "left")
    wide = hot_left_join(wide, payment, ["uid", "dn"], n, min_rows)
    return _present(wide.join(vip, ["vip_id", "dn"], "left"), DWS_MEMBER)


def _lookup(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """One row per key of a lookup: its smallest row and how many there are."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias(weight))
            .select(*keys, weight, "_row.*"))


def _have(df: DataFrame, names: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in names if c in have]


def member_wide_agg(member: DataFrame, regtype: DataFrame, ad: DataFrame, site: DataFrame, payment: DataFrame,
                    vip: DataFrame, zero: bool = False) -> DataFrame:
    """One row per member, site and day: attributes, summed payments, best vip level.

    This is the join of all six inputs followed by one aggregation, computed
    the other way round: each input is folded to one row per key, keeping the
    number of rows it had, and only then joined. A member with r registrations
    and payments p contributes r * sum(p) to the sum either way, but here a
    member owning any share of the payments is reduced before the shuffle.

    Attributes come from one row, the smallest (for registrations: the
    earliest). ``zero`` gives the second form: no payment is 0.00 as text and
    the next vip level is that of the chosen row, not the highest.
    """
    ad1, site1, vip1 = (_lookup(ad, ["ad_id", "dn"], "_ad_n"), _lookup(site, ["siteid", "dn"], "_site_n"),
                        _lookup(vip, ["vip_id", "dn"], "_vip_n"))

    who = member.join(ad1, ["ad_id", "dn"], "left")
    who_cols = _have(who, MEMBER + AD)
    who = (who.groupBy("uid", "dn", "dt")
           .agg(F.min(F.struct(*who_cols)).alias("_who"),
                F.sum(F.coalesce("_ad_n", F.lit(1))).alias("_who_n")))

    reg = regtype.join(site1, ["siteid", "dn"], "left")
    order = ["reg_createtime"] + [c for c in _have(reg, REGTYPE + SITE) if c != "reg_createtime"]
    reg = (reg.groupBy("uid", "dn")
           .agg(F.min(F.struct(*order)).alias("_reg"),
                F.sum(F.coalesce("_site_n", F.lit(1))).alias("_reg_n")))

    # Payments are the long table: they are summed per level by hash, and only the
    # sums meet the vip texts, whose maxima Spark can aggregate by sorting alone.
    per_level = payment.groupBy("uid", "dn", "vip_id").agg(F.sum("paymoney").cast(MONEY).alias("paymoney"))
    paid = per_level.join(vip1, ["vip_id", "dn"], "left")
    vip_row = ["vip_id"] + _have(paid, ["vip_max_free", "vip_min_free", "vip_operator", "vip_next_level"])
    level = F.when(F.col("_vip_n").isNotNull(), F.struct(*vip_row))
    paid = (paid.groupBy("uid", "dn")
            .agg(F.sum((F.col("paymoney") * F.coalesce("_vip_n", F.lit(1))).cast(MONEY)).alias("_pay"),
                 F.min(level).alias("_vip"),
                 F.max("vip_level").alias("vip_level"),
                 F.min("vip_start_time").alias("vip_start_time"),
                 F.max("vip_end_time").alias("vip_end_time"),
                 F.max("vip_last_modify_time").alias("vip_last_modify_time"),
                 F.max("vip_next_level").alias("_top_next_level")))

    total = (F.col("_pay") * F.col("_who_n") * F.coalesce("_reg_n", F.lit(1))).cast(MONEY)
    if zero:
        total = F.coalesce(total.cast("string"), F.lit("0.00"))
        next_level = F.col("_vip.vip_next_level")
    else:
        next_level = F.col("_top_next_level")
    wide = who.join(reg, ["uid", "dn"], "left").join(paid, ["uid", "dn"], "left")
    wide = wide.select("uid", "dt", "dn", "_who.*", "_reg.*", total.alias("paymoney"),
                       *[F.col(f"_vip.{c}").alias(c) for c in vip_row if c != "vip_next_level"],
                       "vip_level", "vip_start_time", "vip_end_time", "vip_last_modify_time",
                       next_level.alias("vip_next_level"))
    return _present(wide, DWS_MEMBER)


def member_wide_sql(spark: SparkSession, views: dict[str, str]) -> DataFrame:
    """The same wide row in SQL, over named views; join first, then aggregate.

    Kept as the plain statement of the result: it needs no folding to read,
    and a test holds ``member_wide_agg`` against it.
    """
    head = ", ".join(f"min(m.{c}) AS {c}" for c in MEMBER)
    reg = ", ".join(f"min_by(r.{c}, r.reg_createtime) AS {c}" for c in REGTYPE)
    site = ", ".join(f"min_by(s.{c}, r.reg_createtime) AS {c}" for c in SITE)
    vip = ", ".join(f"min_by(v.{c}, v.vip_id) AS {c}" for c in VIP_FIRST)
    return spark.sql(f"""
        SELECT m.uid, {head}, CAST(sum(p.paymoney) AS {MONEY}) AS paymoney, {reg}, min(a.adname) AS adname, {site},
               {vip}, max(v.vip_level) AS vip_level, min(v.vip_start_time) AS vip_start_time,
               max(v.vip_end_time) AS vip_end_time, max(v.vip_last_modify_time) AS vip_last_modify_time,
               max(v.vip_next_level) AS vip_next_level, m.dt, m.dn
        FROM {views['member']} m
        LEFT JOIN {views['member_regtype']} r ON r.uid = m.uid AND r.dn = m.dn
        LEFT JOIN {views['base_ad']} a ON a.ad_id = m.ad_id AND a.dn = m.dn
        LEFT JOIN {views['base_website']} s ON s.siteid = r.siteid AND s.dn = m.dn
        LEFT JOIN {views['member_payment']} p ON p.uid = m.uid AND p.dn = m.dn
        LEFT JOIN {views['vip_level']} v ON v.vip_id = p.vip_id AND v.dn = m.dn
        GROUP BY m.uid, m.dn, m.dt""").select(*DWS_MEMBER)


def payment_vip_join(payment: DataFrame, vip: DataFrame, dt: str | None = None) -> DataFrame:
    """Payments of a day that belong to a vip level."""
    day = payment if dt is None else payment.where(F.col("dt") == F.lit(dt))
    return day.join(vip, ["vip_id", "dn"], "inner")
