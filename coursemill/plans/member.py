"""Member area: wide table, payment history, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions.scalars import dt_to_date
from coursemill.operators.history import HISTORY, daily_payment_delta, scd2_merge
from coursemill.operators.joins import BROADCAST_LIMIT, estimated_bytes
from coursemill.operators.member import DWS_MEMBER, member_wide_agg
from coursemill.operators.metrics import MEMBER_COUNTS, counts_of, member_counts, top3_payers
from coursemill.operators.sinks import read_partitions, replace_partitions, write_overwrite
from coursemill.sources.tables import read_table, scan, table_exists, table_path

# fixed values: report tables
COUNT_TABLES = {
    "appregurl": "ads_register_appregurlnum",
    "sitename": "ads_register_sitenamenum",
    "regsourcename": "ads_register_regsourcenamenum",
    "adname": "ads_register_adnamenum",
    "memberlevel": "ads_register_memberlevelnum",
    "vip_level": "ads_register_viplevelnum",
}
TOP_TABLE = "ads_register_top3memberpay"
INPUTS = ["member_regtype", "base_ad", "base_website", "member_payment", "vip_level"]
OF_MEMBERS = ["member_regtype", "member_payment"]
END_MONTH = "end_month"


def build_member_wide(spark: SparkSession, root: str, dt: str) -> None:
    """Members of a day with everything known about them; of tables by member, the rows of these members."""
    members = scan(spark, root, "member", dt)
    inputs = {n: scan(spark, root, n) for n in INPUTS}
    uids = members.select("uid").distinct()
    if estimated_bytes(uids) <= BROADCAST_LIMIT:
        inputs |= {n: inputs[n].join(F.broadcast(uids), "uid", "left_semi") for n in OF_MEMBERS}
    wide = member_wide_agg(members, *inputs.values())
    write_overwrite(wide.select(*DWS_MEMBER), table_path(root, "dws.dws_member"))


def build_member_history(spark: SparkSession, root: str, dt: str) -> None:
    """Apply the payments of a day to the history.

    History rows are stored by the month they end in, open ones in a month of
    their own. Rows that ended in earlier months are neither read nor written.
    """
    delta = daily_payment_delta(read_table(spark, root, "dwd.dwd_pcentermempaymoney"),
                                read_table(spark, root, "dwd.dwd_vip_level"), dt).persist()
    day = spark.range(1).select(dt_to_date(F.lit(dt))).first()[0]
    path = table_path(root, "dws.dws_member_zipper")
    if table_exists(spark, path):
        stored = read_partitions(spark.read.parquet(path)).withColumn(END_MONTH, F.col(END_MONTH).cast("string"))
        stored = stored.where(F.col(END_MONTH).isNull() | (F.col(END_MONTH) >= day[:7]))
    else:
        stored = delta.limit(0).withColumn(END_MONTH, F.lit(None).cast("string"))
    merged = scd2_merge(stored.select(*HISTORY), delta, day).withColumn(END_MONTH, F.substring("end_time", 1, 7))
    replace_partitions(merged, stored, path, END_MONTH)
    delta.unpersist()


def read_member_history(spark: SparkSession, root: str) -> DataFrame:
    return read_partitions(spark.read.parquet(table_path(root, "dws.dws_member_zipper"))).select(*HISTORY)


def build_member_reports(spark: SparkSession, root: str, dt: str) -> None:
    """Six counts, read from the wide table once, and the best payers of a day."""
    wide = scan(spark, root, "member_wide", dt)
    counts = member_counts(wide).persist()
    for report, by in MEMBER_COUNTS.items():
        write_overwrite(counts_of(counts, report), table_path(root, f"ads.{COUNT_TABLES[by]}"))
    counts.unpersist()
    write_overwrite(top3_payers(wide), table_path(root, f"ads.{TOP_TABLE}"))
