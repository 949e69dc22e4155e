from __future__ import annotations

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from coursemill.operators import joins as J
from coursemill.operators import member as M
from coursemill.operators.sinks import split_hot, write_bucketed
from coursemill.session import scratch_dir

SALE = "courseid int, dt string, dn string, coursename string, money int"
CART = "courseid int, orderid string, coursename string, discount int, sellmoney int, createtime string, dt string, dn string"
ANY_SIZE = 1 << 70  # frames made from Python objects have no known size, which counts as too large
PAY = "orderid string, discount int, paymoney int, createtime string, dt string, dn string"


@pytest.fixture
def sales(frame):
    sale = frame(SALE, (1, "d", "w", "math", 10), (2, "d", "w", "art", 20), (3, "x", "w", "other day", 1))
    cart = frame(CART, *[(1, f"o{i % 7}", "cart name", i, i, "t", "d", "w") for i in range(40)],
                 (9, "o1", "n", 0, 0, "t", "d", "w"), (None, None, "n", 0, 0, "t", "d", "w"), (3, "o3", "n", 1, 1, "t", "d", "w"))
    pay = frame(PAY, ("o1", 5, 50, "p", "d", "w"), ("o2", 6, 60, "p", "x", "w"), ("o3", 6, 70, "p", "d", "w"))
    return sale, cart, pay


def test_cart_join_keeps_every_cart_row_and_its_course(sales):
    got = J.cart_join(*sales)
    assert got.columns == [c for c in J.SALES_DETAIL if c in got.columns]
    assert got.count() == 43
    assert rows_of(got.where("courseid = 9"), "courseid", "coursename", "orderid", "paymoney") == [(9, None, "o1", 50)]
    assert got.where("orderid = 'o2' and paymoney is not null").count() == 0  # paid on another day
    assert got.where("courseid = 3 and coursename is not null").count() == 0


def test_all_forms_of_the_cart_join_agree(spark, sales):
    sale, cart, pay = sales
    want = rows_of(J.cart_join(*sales))
    assert rows_of(J.cart_join_salted(*sales, n=5)) == want
    assert rows_of(J.cart_join_broadcast(*sales, limit=ANY_SIZE)) == want
    assert rows_of(J.cart_join_broadcast(*sales, limit=0)) == want  # too large: salted instead
    for name, df in (("cart_t", cart), ("pay_t", pay)):
        write_bucketed(df, name, scratch_dir(spark, name), "orderid", 4, mode="overwrite")
    bucketed = J.cart_join_bucketed(sale, spark.table("cart_t"), spark.table("pay_t"))
    assert rows_of(bucketed) == want
    joins = plan_of(bucketed)
    assert "hashpartitioning(orderid" not in joins

    cold, hot = split_hot(cart, "orderid", 5)
    assert 0 < hot.count() < cart.count()
    write_bucketed(cold, "cart_cold", scratch_dir(spark, "cart_cold"), "orderid", 4, mode="overwrite")
    assert rows_of(J.cart_join_bucketed(sale, spark.table("cart_cold"), spark.table("pay_t"), hot)) == want


def test_bucketed_join_has_no_exchange_below_the_join(spark, sales):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, cart, pay = sales
        for name, df in (("cart_b", cart), ("pay_b", pay)):
            write_bucketed(df, name, scratch_dir(spark, name), "orderid", 4, mode="overwrite")
        plan = plan_of(J.cart_join_bucketed(sales[0], spark.table("cart_b"), spark.table("pay_b"), limit=ANY_SIZE))
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_form_ships_the_course_side(sales):
    assert "BroadcastHashJoin" in plan_of(J.cart_join_broadcast(*sales, limit=ANY_SIZE))


def test_salted_join_refuses_kinds_that_would_add_rows(sales):
    with pytest.raises(ValueError):
        J.salted_join(sales[0], sales[1], ["courseid"], "left")


@pytest.mark.parametrize("min_rows", [0, 3, 1000])
def test_hot_left_join_equals_left_join(frame, min_rows):
    left = frame("k int, dn string, a int", (1, "w", 1), (1, "w", 2), (2, "w", 3), (3, "w", 4), (None, "w", 5))
    right = frame("k int, dn string, b int", *[(1, "w", i) for i in range(20)], (2, "w", 7), (4, "w", 8), (None, "w", 9))
    want = rows_of(left.join(right, ["k", "dn"], "left"), "k", "dn", "a", "b")
    assert rows_of(J.hot_left_join(left, right, ["k", "dn"], 6, min_rows), "k", "dn", "a", "b") == want


def test_equal_rows_are_dealt_over_the_salts(spark, frame):
    big = frame("k int, v string", *[(1, "same")] * 1000, (1, "other"), (2, "x"), (None, "y"))
    salted = J.spread_folded(J.fold_equal(big), 100)
    share = {r[J.SALT]: r[J.TIMES] for r in salted.where("v = 'same'").collect()}
    assert len(share) == 100 and set(share.values()) == {10}
    few = J.spread_folded(J.fold_equal(frame("k int", *[(1,)] * 7)), 100).collect()
    assert [r[J.TIMES] for r in few] == [1] * 7 and len({r[J.SALT] for r in few}) == 7
    odd = J.spread_folded(J.fold_equal(frame("k int", *[(1,)] * 7)), 3).collect()
    assert sorted(r[J.TIMES] for r in odd) == [2, 2, 3]
    small = frame("k int, name string", (1, "a"), (3, "c"))
    for how in ("right", "inner"):
        assert rows_of(J.salted_join(small, big, ["k"], how, 100)) == rows_of(small.join(big, ["k"], how))
    got = J.hot_left_join(small, big, ["k"], 100, 10)
    assert rows_of(got) == rows_of(small.join(big, ["k"], "left"))


def test_copies_of_the_small_side_are_never_broadcast(spark):
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
    big = spark.range(400).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    for how in ("right", "inner"):
        got = J.salted_join(small, big, ["k"], how, 100)
        assert "BroadcastHashJoin" not in plan_of(got) and "SortMergeJoin" in plan_of(got)
        assert rows_of(got) == rows_of(small.join(big, ["k"], how))


def test_unfolding_goes_in_bounded_steps(frame):
    got = J.unfold(frame("a int, _times bigint", (1, 2 * J.AT_ONCE + 1), (2, 1), (3, None), (4, J.AT_ONCE)))
    assert rows_of(got.groupBy("a").count()) == [(1, 2 * J.AT_ONCE + 1), (2, 1), (3, 1), (4, J.AT_ONCE)]


# --- member wide table ----------------------------------------------------------------

@pytest.fixture
def members(spark, frame):
    def text(names):
        return ", ".join(f"{n} string" for n in names)
    who = [c for c in M.MEMBER if c != "ad_id"]
    member = frame(f"uid int, ad_id int, {text(who)}, dt string, dn string",
                   *[(u, a, *[f"{c}{u}" for c in who], "d1", "w") for u, a in ((1, 1), (2, 1), (3, 9), (4, None))],
                   (1, 1, *[f"{c}1" for c in who], "d2", "w"))
    reg = [c for c in M.REGTYPE if c not in ("siteid", "reg_createtime")]
    regtype = frame(f"uid int, reg_createtime string, siteid int, {text(reg)}, dn string",
                    (1, "2", 1, *["b" for _ in reg], "w"), (1, "1", 2, *["a" for _ in reg], "w"),
                    (2, "1", 7, *["c" for _ in reg], "w"), (3, "1", 1, *["x" for _ in reg], "other"))
    ad = frame("ad_id int, adname string, dn string", (1, "A", "w"), (2, "B", "w"))
    site = frame(f"siteid int, {text(M.SITE)}, dn string", *[(i, *[f"s{i}" for _ in M.SITE], "w") for i in (1, 2)])
    pay = frame("uid int, paymoney decimal(10,4), vip_id int, dn string",
                *[(1, __import__("decimal").Decimal(x), v, "w") for x, v in (("10.5", 1), ("1.25", 2), ("3", 9))],
                (2, None, 1, "w"), (5, __import__("decimal").Decimal("8"), 1, "w"))
    vip = frame(f"vip_id int, {text(M.VIP)}, dn string", (1, *["l1"] * len(M.VIP), "w"), (2, *["l2"] * len(M.VIP), "w"))
    return [member, regtype, ad, site, pay, vip]


def test_member_wide_agg_equals_join_then_group(spark, members):
    names = ["member", "member_regtype", "base_ad", "base_website", "member_payment", "vip_level"]
    for name, df in zip(names, members):
        df.createOrReplaceTempView(f"v_{name}")
    want = M.member_wide_sql(spark, {n: f"v_{n}" for n in names})
    got = M.member_wide_agg(*members)
    assert got.columns == M.DWS_MEMBER
    assert rows_of(got) == rows_of(want)


def test_two_registrations_double_the_payments(members):
    got = {(r.uid, r.dt): r for r in M.member_wide_agg(*members).collect()}
    assert str(got[1, "d1"].paymoney) == "29.5000"  # 14.75 for each of two registrations
    assert got[1, "d1"].appkey == "a" and got[1, "d1"].sitename == "s2"  # the earliest registration
    assert got[2, "d1"].paymoney is None and got[3, "d1"].regsource is None
    assert got[1, "d1"].vip_level == "l2" and got[1, "d1"].vip_operator == "l1"


def test_zero_form(members):
    got = {(r.uid, r.dt): r for r in M.member_wide_agg(*members, zero=True).collect()}
    assert got[2, "d1"].paymoney == "0.00" and got[4, "d1"].paymoney == "0.00"
    assert got[1, "d1"].vip_next_level == "l1"  # of the chosen row, not the highest


@pytest.mark.parametrize("min_rows", [0, 1000])
def test_member_wide_join_has_one_row_per_match(members, min_rows):
    got = M.member_wide_join(*members, n=3, min_rows=min_rows)
    per_uid = {tuple(r)[:2]: r["count"] for r in got.groupBy("uid", "dt").count().collect()}
    assert per_uid == {(1, "d1"): 6, (1, "d2"): 6, (2, "d1"): 1, (3, "d1"): 1, (4, "d1"): 1}


def test_payment_vip_join(frame):
    pay = frame("uid int, vip_id int, dt string, dn string", (1, 1, "a", "w"), (1, 2, "a", "w"), (1, 1, "b", "w"))
    vip = frame("vip_id int, dn string, vip_level string", (1, "w", "l1"))
    assert M.payment_vip_join(pay, vip, "a").count() == 1


# --- question bank --------------------------------------------------------------------

def test_paper_join_keeps_views_without_centre(frame):
    view = frame("paperviewid int, paperid int, dn string, dt string", (1, 1, "w", "d"), (2, 1, "w", "d"), (3, 8, "w", "d"))
    cp = frame("paperviewid int, centerid int, sequence string, dn string", (1, 5, "s", "w"))
    center = frame("centerid int, centername string, dn string", (6, "c", "w"))
    paper = frame("paperid int, papername string, dn string", (1, "p", "w"))
    got = J.paper_join(view, cp, center, paper)
    assert rows_of(got, "paperviewid", "centerid", "centername", "papername") == [(1, 5, None, "p"), (2, None, None, "p")]


def test_answers_multiply_by_chapter_rows_unless_folded(frame):
    answers = frame("userid int, paperviewid int, chapterid int, sitecourseid int, questionid int, majorid int, "
                    "paperid int, question_answer int, dt string, dn string", (1, 1, 1, 1, 1, 1, 7, 1, "d", "w"))
    key = lambda k, *extra: frame(f"{k} int, dn string" + "".join(f", {e} int" for e in extra), (1, "w", *range(len(extra))))
    chapter = frame("chapterid int, pointid int, dn string", (1, 1, "w"), (1, 2, "w"))
    args = (answers, key("sitecourseid", "courseid", "majorid"), chapter, key("majorid"), key("paperviewid", "paperid", "courseid"), key("questionid"))
    assert J.answer_detail_join(*args).count() == 2
    once = J.answer_detail_join(*args, distinct_chapter=True).collect()
    assert len(once) == 1 and once[0].paperid == 0 and once[0].user_question_answer == 1


# --- state and ranges ------------------------------------------------------------------

def test_state_full_outer_merge(frame):
    h = frame("k string, n bigint", ("a", 1), ("b", 2), (None, 5))
    b = frame("k string, n bigint", ("b", 10), ("c", 20), (None, 1))
    assert rows_of(J.state_full_outer_merge(h, b, ["k"], ["n"])) == [("a", 1), ("b", 12), ("c", 20), (None, 6)]


def test_ip_region_join(frame):
    rows = frame("ip string", ("0.0.0.5",), ("1.0.0.0",), ("1.2.3.4",), ("9.9.9.9",), ("bad",))
    ranges = frame("lo bigint, hi bigint, region string", (0, 10, "c|0|p1|t|i"), (16777216, 16909060, "c|0|p2|t|i"))
    got = J.ip_region_join(rows, ranges)
    assert rows_of(got) == [("0.0.0.5", "c|0|p1|t|i"), ("1.0.0.0", "c|0|p2|t|i"), ("1.2.3.4", "c|0|p2|t|i"),
                            ("9.9.9.9", None), ("bad", None)]
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_rename_drop_ignores_absent_columns(frame):
    assert J.rename_drop(frame("a int, b int", (1, 2)), {"a": "x", "q": "z"}, ["b", "c"]).columns == ["x"]


def test_salt_is_stable(frame):
    df = frame("a int", *[(i,) for i in range(50)])
    salted = lambda: rows_of(J.spread_folded(J.fold_equal(df), 7), "a", J.SALT)
    assert salted() == salted() and len({s for _, s in salted()}) > 1
