"""Page transitions and the conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import percent_text
from coursemill.operators.joins import state_full_outer_merge

TRIPLE = ["last_page_id", "page_id", "next_page_id"]
FUNNEL_PAGES = (1, 2, 3)  # fixed values: pages of the funnel, in order


def page_transition_count(pages: DataFrame) -> DataFrame:
    return pages.groupBy(*TRIPLE).agg(F.count(F.lit(1)).alias("num"))


def page_visit_total(transitions: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Visits per page, added to stored totals (page_id, num) if there are any."""
    visits = transitions.groupBy("page_id").agg(F.sum("num").alias("num"))
    return visits if history is None else state_full_outer_merge(history, visits, ["page_id"], ["num"])


def page_funnel(totals: DataFrame, pages: tuple[int, ...] = FUNNEL_PAGES) -> DataFrame:
    """Visits of each funnel page and their share of the page before; the first is 100%."""
    nums = [F.coalesce(F.sum(F.when(F.col("page_id").cast("int") == p, F.col("num"))), F.lit(0)) for p in pages]
    row = totals.agg(*[n.alias(f"n{i}") for i, n in enumerate(nums)])
    steps = []
    for i, page in enumerate(pages):
        rate = F.lit("100%") if i == 0 else percent_text(F.col(f"n{i}"), F.col(f"n{i - 1}"))
        steps.append(F.struct(F.lit(page).alias("page_id"), F.col(f"n{i}").alias("num"), rate.alias("jump_rate")))
    return row.select(F.inline(F.array(*steps)))


def page_rates(transitions: DataFrame, pages: tuple[int, ...] = FUNNEL_PAGES) -> DataFrame:
    """Share of each funnel page, (page_id, jump_rate)."""
    return page_funnel(page_visit_total(transitions), pages).select("page_id", "jump_rate")


def page_jump_rate(transitions: DataFrame, pages: tuple[int, ...] = FUNNEL_PAGES) -> DataFrame:
    """Every transition with the share of its page; pages beside the funnel have none."""
    rates = page_rates(transitions, pages).alias("r")
    on = F.col("t.page_id").cast("int") == F.col("r.page_id")
    return transitions.alias("t").join(rates, on, "left").select(*[f"t.{c}" for c in TRIPLE], "t.num", "r.jump_rate")
