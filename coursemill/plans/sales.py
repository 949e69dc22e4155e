"""Course sales: one detail table, built by any of four physical plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursemill.operators import joins as J
from coursemill.operators.sinks import write_overwrite
from coursemill.plans.detail import hot_path
from coursemill.sources.specs import SCANS
from coursemill.sources.tables import scan, scan_table, table_exists, table_path

FORMS = {
    "plain": (J.cart_join, ("cart", "pay")),
    "salted": (J.cart_join_salted, ("cart", "pay")),
    "broadcast": (J.cart_join_broadcast, ("cart", "pay")),
    "bucketed": (J.cart_join_bucketed, ("cart_bucketed", "pay_bucketed")),
}


def _bucketed(spark: SparkSession, root: str, table: str, columns: str, dt: str) -> tuple[DataFrame, DataFrame | None]:
    """A bucketed table and, if there are any, its rows of values too frequent for a bucket."""
    name = table.partition(".")[2]
    cold = scan_table(spark.table(name), columns, dt)
    path = hot_path(root, name)
    if not table_exists(spark, path):
        return cold, None
    return cold, scan_table(spark.read.schema(cold.schema).parquet(path), columns, dt)


def build_sales_detail(spark: SparkSession, root: str, dt: str, form: str = "plain") -> None:
    join, inputs = FORMS[form]
    if form == "bucketed":  # buckets are known to the catalog, not to the files
        frames = [_bucketed(spark, root, *SCANS[n], dt) for n in inputs]
        pay, hot_pay = frames[1]
        frames = [frames[0][0], pay if hot_pay is None else pay.unionByName(hot_pay), frames[0][1]]
    else:
        frames = [scan(spark, root, n, dt) for n in inputs]
    write_overwrite(join(scan(spark, root, "sale_course", dt), *frames), table_path(root, "dws.dws_salecourse_detail"))
