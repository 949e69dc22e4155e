from __future__ import annotations

import re
from decimal import Decimal

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from coursemill.operators import metrics as M
from coursemill.operators import pages as P
from coursemill.operators import regions as R
from coursemill.operators import sketch as B

D = Decimal
DETAIL = ("userid int, paperviewid int, paperviewname string, score decimal(4,1), spendtime int, questionid int, "
          "user_question_answer int, dt string, dn string")


@pytest.fixture
def detail(frame):
    return lambda *rows: frame(DETAIL, *[(u, p, f"n{p}", None if s is None else D(s), 10, q, a, dt, "w")
                                         for u, p, s, q, a, dt in rows])


def test_member_count_keeps_null_as_a_value(frame):
    wide = frame("adname string, dn string, dt string", ("a_b", "w", "d"), ("a_b", "w", "d"), (None, "w", "d"), ("a", "b_w", "d"),
                 ("a_b", "w", "e"))
    assert rows_of(M.member_count(wide, "adname", "d")) == [("a", 1, "d", "b_w"), ("a_b", 2, "d", "w"), (None, 1, "d", "w")]


def test_top3_payers_breaks_ties_by_uid_and_puts_null_last(frame):
    wide = frame("uid int, memberlevel string, paymoney decimal(10,4), dt string, dn string",
                 (3, "a", D(5), "d", "w"), (1, "a", D(5), "d", "w"), (2, "a", None, "d", "w"), (4, "a", D(9), "d", "w"),
                 (5, "b", None, "d", "w"), (6, "a", D(99), "e", "w"))
    got = [(r.uid, r.rownum) for r in M.top3_payers(wide, "d").collect()]
    assert got == [(4, 1), (1, 2), (3, 3), (5, 1)]


def test_top3_payers_limits_each_group_before_the_shuffle(frame):
    wide = frame("uid int, memberlevel string, paymoney int, dt string, dn string", (1, "a", 1, "d", "w"))
    plan = plan_of(M.top3_payers(wide))
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_paper_avg_and_extremes(detail):
    df = detail((1, 1, "10.5", 1, 1, "d"), (2, 1, "10.0", 1, 1, "d"), (3, 1, None, 1, 1, "d"), (1, 1, "99", 1, 1, "e"))
    assert rows_of(M.paper_avg(df, "d")) == [(1, "n1", D("10.3"), D("10.0"), "d", "w")]  # 10.25 half up
    assert rows_of(M.paper_max_min(df, "d")) == [(1, "n1", D("10.5"), D("10.0"), "d", "w")]


@pytest.mark.parametrize("best", [True, False])
def test_ranked_answers_equal_a_dense_rank(detail, best):
    from pyspark.sql.window import Window
    df = detail(*[(i, i % 3, None if i % 17 == 0 else str(i * 7 % 11), 1, 1, "d") for i in range(60)])
    order = F.desc("score") if best else F.asc("score")
    want = (df.withColumn("rk", F.dense_rank().over(Window.partitionBy("paperviewid").orderBy(order))).where("rk < 4")
            .select("userid", "paperviewid", "score", "rk"))
    got = (M.paper_top3 if best else M.paper_low3)(df, "d")
    assert rows_of(got, "userid", "paperviewid", "score", "rk") == rows_of(want)


@pytest.mark.parametrize("size", [1, 3, 4, 10, 1000])
def test_score_segments_cut_long_bands(detail, size):
    users = [(u % 37, 1, "15", 1, 1, "d") for u in range(90)] + [(5, 1, "15", 1, 1, "d")] * 9 + [
        (7, 2, "100", 1, 1, "d"), (8, 2, None, 1, 1, "d"), (9, 2, "101", 1, 1, "d")]
    got = M.score_segment_users(detail(*users), "d", ids_per_row=size).collect()
    parts: dict = {}
    for r in got:
        assert 0 < len(r.userids.split(",")) <= size
        parts.setdefault((r.paperviewid, r.score_segment), []).append((r.part, r.userids))
    assert [p for p, _ in sorted(parts[1, "0-20"])] == list(range(-(-99 // size)))
    ids = [int(i) for _, text in sorted(parts[1, "0-20"]) for i in text.split(",")]
    assert ids == sorted(u for u, p, *_ in users if p == 1)
    assert sorted(i for _, text in parts[2, None] for i in text.split(",")) == ["8", "9"]


def test_rows_of_short_bands_are_shuffled_once_and_not_by_user(detail):
    got = M.score_segment_users(detail(*[(u, u % 4, "15", 1, 1, "d") for u in range(40)]), "d")
    assert len(got.collect()) == 4
    keys = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan_of(got).split("== Initial Plan ==")[0])
    assert keys and not any("userid" in k for k in keys)


def test_bands_that_share_a_slot_are_told_apart(detail):
    rows = detail(*[(u, int(u % 10 == 0), "15", 1, 1, "d") for u in range(40)]).withColumn("score_segment", F.lit("0-20"))
    for slots in (1, 1 << 16):
        assert rows_of(M._long_bands(rows, 20, slots), "paperviewid") == [(0,)]


def test_pass_rate_needs_both_sides(detail):
    df = detail((1, 1, "0", 1, 1, "d"), (2, 1, "60", 1, 1, "d"), (3, 1, "60.5", 1, 1, "d"), (4, 2, "99", 1, 1, "d"),
                (5, 3, "1", 1, 1, "d"), (6, 1, None, 1, 1, "d"), (7, 1, "-1", 1, 1, "d"))
    assert rows_of(M.paper_pass_rate(df, "d")) == [(1, "n1", 2, 1, D("0.33"), "d", "w")]


def test_pass_rate_counts_passes_whatever_the_paper_is_called(frame):
    df = frame(DETAIL, (1, 1, "old", D(10), 1, 1, 1, "d", "w"), (2, 1, "new", D(90), 1, 1, 1, "d", "w"))
    assert rows_of(M.paper_pass_rate(df, "d")) == [(1, "old", 1, 1, D("0.50"), "d", "w")]


def test_question_error_rate(detail):
    df = detail(*[(i, 1, "1", q, a, "d") for i, (q, a) in enumerate([(1, 0), (1, 0), (1, 1), (2, 0), (3, 1), (4, 0), (4, 1)])])
    got = [tuple(r) for r in M.question_error_rate(df, "d").collect()]
    assert got == [(1, 2, 1, D("0.67"), "d", "w"), (4, 1, 1, D("0.50"), "d", "w")]
    assert M.question_error_rate(df, "d", limit=1).count() == 1


def test_rates_of_two_forms_agree(detail):
    df = detail(*[(i, 1, "1", i % 5, i * 3 % 2, "d") for i in range(50)])
    wrong = df.where("user_question_answer = 0").groupBy("questionid", "dt", "dn").agg(F.count("*").alias("errcount"))
    right = df.where("user_question_answer = 1").groupBy("questionid", "dn").agg(F.count("*").alias("rightcount"))
    pair = M.rate_pair_join(wrong, right, ["questionid", "dn"], "errcount", "rightcount")
    cols = ["questionid", "errcount", "rightcount", "rate"]
    assert rows_of(pair, *cols) == rows_of(M.question_error_rate(df), *cols)


def test_filter_on_a_column_not_shown(frame):
    df = frame("a int, s int", (1, 0), (2, 60), (3, 61), (4, None))
    assert rows_of(M.filter_after_project(df, ["a"], F.col("s").between(0, 60))) == [(1,), (2,)]


def test_equal_rows_read_by_several_tasks_are_counted_apart_first(spark, frame):
    df = spark.range(1000).repartition(8).select(F.lit("a").alias("k"))
    assert rows_of(M.salted_count(df, "k", 4)) == [("a", 1000)]
    assert df.groupBy("k", F.spark_partition_id() % 4).count().count() == 4


def test_all_member_counts_come_from_one_scan(spark, frame, tmp_path):
    cols = [*M.MEMBER_COUNTS.values(), "dt", "dn"]
    rows = [(*[None if (i + j) % 5 == 0 else f"v{(i * j) % 3}" for j in range(6)], f"d{i % 2}", "w") for i in range(40)]
    frame(", ".join(f"{c} string" for c in cols), *rows).write.parquet(str(tmp_path / "w"))
    wide = spark.read.parquet(str(tmp_path / "w"))
    counts = M.member_counts(wide)
    assert plan_of(counts).count("FileScan") == 1
    for report, by in M.MEMBER_COUNTS.items():
        assert rows_of(M.counts_of(counts, report)) == rows_of(M.member_count(wide, by))


def test_paper_reports_share_one_scan(spark, frame, tmp_path):
    frame("paperviewid int, paperviewname string, score decimal(4,1), spendtime int, dt string, dn string",
          *[(i % 3, f"p{i % 3}", Decimal(i * 7 % 101), i, "d", "w") for i in range(30)]).write.parquet(str(tmp_path / "d"))
    detail = spark.read.parquet(str(tmp_path / "d"))
    one = M.paper_summary(detail)
    assert plan_of(one).count("FileScan") == 1
    for of, report in ((M.avg_of, M.paper_avg), (M.max_min_of, M.paper_max_min), (M.pass_rate_of, M.paper_pass_rate)):
        assert rows_of(of(one)) == rows_of(report(detail))


def test_salted_count(frame):
    df = frame("k string, i int", *[("a", i) for i in range(50)], ("b", 1), (None, 1))
    assert rows_of(M.salted_count(df, "k")) == [("a", 50), ("b", 1), (None, 1)]


# --- pages and regions ----------------------------------------------------------------

def test_funnel(frame):
    trans = frame("last_page_id string, page_id string, next_page_id string, num bigint",
                  ("0", "1", "2", 8), ("1", "2", "3", 1), ("9", "2", "3", 0), ("2", "3", "4", 5), ("3", "9", "1", 7))
    totals = P.page_visit_total(trans)
    assert rows_of(P.page_funnel(totals)) == [(1, 8, "100%"), (2, 1, "12%"), (3, 5, "500%")]
    hist = frame("page_id string, num bigint", ("2", 3), ("7", 1))
    assert rows_of(P.page_funnel(P.page_visit_total(trans, hist))) == [(1, 8, "100%"), (2, 4, "50%"), (3, 5, "125%")]


def test_funnel_without_visits(frame):
    empty = frame("page_id string, num bigint")
    assert rows_of(P.page_funnel(empty)) == [(1, 0, "100%"), (2, 0, "0%"), (3, 0, "0%")]


def test_region_counts_and_top(frame):
    rows = frame("ip string", *[("0.0.0.1",)] * 3, *[("0.1.0.0",)] * 2, ("9.0.0.0",), ("0.2.0.1",), ("0.2.0.1",))
    ranges = frame("lo bigint, hi bigint, region string", (0, 255, "c|0|p1|t|i"), (65536, 65536, "c|0|p2|t|i"),
                   (131072, 200000, "c|0|p0|t|i"))
    counts = R.ip_region_counts(rows, ranges)
    assert rows_of(counts) == [("0", 1), ("p0", 2), ("p1", 3), ("p2", 2)]
    assert [tuple(r) for r in R.topk_region(counts, 2).collect()] == [("p1", 3), ("p0", 2)]


def test_limit_rows_does_not_sort_everything(frame):
    plan = plan_of(R.limit_rows(frame("a int", (1,), (2,)), 1, [F.desc("a")]))
    assert "TakeOrderedAndProject" in plan


# --- sketch ----------------------------------------------------------------------------

def test_bloom_has_no_false_negatives_and_keeps_its_bound(spark):
    size, fpp = 20_000, 0.01
    members = spark.range(size).withColumnRenamed("id", "k")
    bloom = B.bloom_build(members, "k", size, fpp)
    probe = spark.range(2 * size).withColumnRenamed("id", "k")
    got = B.bloom_membership(probe, "k", bloom, size, fpp).groupBy((F.col("k") < size).alias("m"), "maybe").count()
    counts = {(r.m, r.maybe): r["count"] for r in got.collect()}
    assert counts[True, True] == size and (True, False) not in counts
    assert counts.get((False, True), 0) <= 2 * fpp * size


def test_bloom_null_and_text_keys(frame):
    bloom = B.bloom_build(frame("k string", ("a",), (None,)), "k", 10)
    got = B.bloom_membership(frame("k string", ("a",), (None,)), "k", bloom, 10)
    assert rows_of(got, "k", "maybe") == [("a", True), (None, False)]


def test_bloom_blocks_are_the_fewest_that_keep_the_bound(spark):
    for size, fpp in ((1, 0.5), (10, 0.01), (1_000_000, 0.01), (50_000, 0.001)):
        blocks = B.bloom_blocks(size, fpp)
        assert B.expected_fpp(size, blocks) <= fpp and (blocks == 1 or B.expected_fpp(size, blocks - 1) > fpp)
    assert 9 < 256 * B.bloom_blocks() / B.SIZE < 12  # bits to a member


def test_bloom_probe_meets_eight_numbers_and_no_text(spark):
    bloom = B.bloom_build(spark.range(100).withColumnRenamed("id", "k"), "k", 100)
    assert [t for _, t in bloom.dtypes] == ["bigint", *["int"] * 8]
    plan = plan_of(B.bloom_membership(spark.range(10).withColumnRenamed("id", "k"), "k", bloom, 100))
    assert "conv(" not in plan and "hex(" not in plan


def test_bloom_keeps_columns_that_share_its_names(frame):
    bloom = B.bloom_build(frame("k int", (1,)), "k", 10)
    got = B.bloom_membership(frame("k int, block string, w0 string", (1, "b", "w")), "k", bloom, 10)
    assert rows_of(got) == [(1, "b", "w", True)]
