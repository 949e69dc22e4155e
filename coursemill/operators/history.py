"""Payment history as slowly changing rows (one row per member and period)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coursemill.functions.scalars import OPEN_END, dt_to_date
from coursemill.operators.joins import fit_to_broadcast, rename_drop
from coursemill.operators.member import MONEY, payment_vip_join
from coursemill.sources.tables import partition_filter

HISTORY = ["uid", "paymoney", "vip_level", "start_time", "end_time", "dn"]


def daily_payment_delta(payment: DataFrame, vip: DataFrame, dt: str | None = None) -> DataFrame:
    """Per member and day: what was paid and the best vip level, as an open row.

    ``dt`` picks one day; without it every day comes out.
    """
    per_level = (partition_filter(payment, dt).groupBy("uid", "dn", "dt", "vip_id")
                 .agg(F.sum(F.col("paymoney").cast("decimal(20,4)")).alias("paymoney")))
    return (payment_vip_join(per_level, rename_drop(vip, drops=["dt"])).groupBy("uid", "dn", "dt")
            .agg(F.sum("paymoney").cast(MONEY).alias("paymoney"),
                 F.max("vip_level").alias("vip_level"))
            .withColumns({"start_time": dt_to_date(F.col("dt")), "end_time": F.lit(OPEN_END)})
            .select(*HISTORY))


def build_history(days: DataFrame) -> DataFrame:
    """The whole history out of one open row per member and day."""
    key = Window.partitionBy("uid", "dn").orderBy("start_time")
    paid = F.sum(F.coalesce(F.col("paymoney").cast(MONEY), F.lit(0).cast(MONEY))).over(
        key.rowsBetween(Window.unboundedPreceding, 0))
    end = F.coalesce(F.lead("start_time").over(key), F.lit(OPEN_END))
    return days.select("uid", paid.cast(MONEY).alias("paymoney"), "vip_level", "start_time",
                       end.alias("end_time"), "dn")


def union_history(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def split_by_delta(history: DataFrame, delta: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """Rows that the rows of ``day`` leave as they are, and those of members that they change.

    Changed are members of the delta and those with a row of an earlier load of the day.
    """
    keys = ["uid", "dn"]
    moved = fit_to_broadcast(delta.select(*keys).union(history.where(F.col("start_time") == day).select(*keys)))
    on = [F.col(f"h.{c}").eqNullSafe(F.col(f"m.{c}")) for c in keys]
    ended = history.where(F.col("end_time") < day).select(*HISTORY)
    open_rows = history.where(F.coalesce(F.col("end_time") >= day, F.lit(True))).select(*HISTORY).alias("h")
    return (union_history(open_rows.join(moved.alias("m"), on, "left_anti"), ended),
            open_rows.join(moved.alias("m"), on, "left_semi"))


def scd2_merge(history: DataFrame, delta: DataFrame, day: str) -> DataFrame:
    """History after the rows of ``day`` (``yyyy-MM-dd``) are applied.

    The open row of a member who paid ends on that day and a new open row
    carries the running total. Loading a day again replaces its rows instead of
    adding to them, and a day that arrives late is slotted in and its payment
    carried into the later rows, so the order of loading does not matter.

    The merge is driven by its keys: members of the delta, and those whose rows
    of an earlier load of the day have to go. Rows of other members and rows
    that ended before ``day`` cannot change and pass through without a shuffle,
    as long as the keys of one day are few enough to be sent to every executor.
    """
    others, stored = split_by_delta(history, delta, day)
    stored = stored.withColumn("_new", F.lit(False))
    fresh = delta.select(*HISTORY, F.lit(True).alias("_new"))
    rows = union_history(stored, fresh)

    key = Window.partitionBy("uid", "dn")
    zero = F.lit(0).cast(MONEY)
    money = F.coalesce(F.col("paymoney").cast(MONEY), zero)
    start, new = F.col("start_time"), F.col("_new")
    before = F.max(F.when(~new & (start < day), money)).over(key)
    replaced = F.max(F.when(~new & (start == day), money)).over(key)
    added = F.max(F.when(new, money)).over(key)
    rows = rows.withColumns({
        "_before": F.coalesce(before, zero),
        "_added": F.coalesce(added, zero),
        "_old": F.coalesce(replaced - F.coalesce(before, zero), zero),
    }).where(new | (start != day))
    paid = (F.when(new, F.col("_before") + money)
            .when(start > day, money - F.col("_old") + F.col("_added"))
            .otherwise(money))
    end = F.coalesce(F.lead("start_time").over(key.orderBy("start_time")), F.lit(OPEN_END))
    changed = rows.select("uid", paid.cast(MONEY).alias("paymoney"), "vip_level", "start_time",
                          end.alias("end_time"), "dn")
    return union_history(changed, others.withColumn("paymoney", F.col("paymoney").cast(MONEY)))
