from __future__ import annotations

import random
from decimal import Decimal

import pytest
from helpers import plan_of, rows_of

from coursemill.operators import history as H

SCHEMA = "uid int, paymoney decimal(20,4), vip_level string, start_time string, end_time string, dn string"


def day_row(uid, day, pay, level="l1"):
    return (uid, None if pay is None else Decimal(pay), level, day, "9999-12-31", "w")


def test_a_new_day_closes_the_open_row_and_rolls_the_payment(frame):
    hist = frame(SCHEMA, (1, Decimal(5), "l1", "2024-01-01", "9999-12-31", "w"), (2, Decimal(7), "l1", "2024-01-01", "9999-12-31", "w"))
    delta = frame(SCHEMA, day_row(1, "2024-01-02", 3, "l2"), day_row(3, "2024-01-02", 1))
    got = rows_of(H.scd2_merge(hist, delta, "2024-01-02"))
    assert got == [(1, Decimal("5.0000"), "l1", "2024-01-01", "2024-01-02", "w"),
                   (1, Decimal("8.0000"), "l2", "2024-01-02", "9999-12-31", "w"),
                   (2, Decimal("7.0000"), "l1", "2024-01-01", "9999-12-31", "w"),
                   (3, Decimal("1.0000"), "l1", "2024-01-02", "9999-12-31", "w")]


def test_same_day_again_replaces_instead_of_adding(frame):
    hist = frame(SCHEMA, (1, Decimal(5), "l1", "2024-01-01", "9999-12-31", "w"))
    once = H.scd2_merge(hist, frame(SCHEMA, day_row(1, "2024-01-02", 3)), "2024-01-02")
    twice = H.scd2_merge(once, frame(SCHEMA, day_row(1, "2024-01-02", 4)), "2024-01-02")
    assert [r[1] for r in rows_of(twice)] == [Decimal("5.0000"), Decimal("9.0000")]
    gone = H.scd2_merge(once, frame(SCHEMA), "2024-01-02")  # corrected: nothing was paid
    assert rows_of(gone) == rows_of(hist)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_loading_gives_the_rebuilt_history(spark, frame, seed):
    rng = random.Random(seed)
    days = [f"2024-01-{d:02d}" for d in range(1, 6)]
    final = {d: [day_row(u, d, rng.randint(0, 9)) for u in range(4) if rng.random() < 0.6] for d in days}
    loads = [(d, [day_row(u, d, 50) for u in range(4) if rng.random() < 0.5]) for d in rng.sample(days, 2)]
    loads += [(d, final[d]) for d in rng.sample(days, len(days))]
    hist = frame(SCHEMA)
    for day, rows in loads:
        merged = H.scd2_merge(hist, frame(SCHEMA, *rows), day).collect()
        hist = frame(SCHEMA, *[tuple(r) for r in merged])
    want = H.build_history(frame(SCHEMA, *[r for d in days for r in final[d]]))
    assert rows_of(hist) == rows_of(want)
    spans: dict = {}
    for uid, _, _, start, end, dn in rows_of(hist):
        spans.setdefault((uid, dn), []).append((start, end))
    for periods in spans.values():
        assert sum(e == "9999-12-31" for _, e in periods) == 1
        periods.sort()
        assert all(a[1] == b[0] for a, b in zip(periods, periods[1:]))


def test_settled_rows_are_not_shuffled(spark, tmp_path, frame):
    frame(SCHEMA, day_row(1, "2024-01-01", 1)).write.parquet(str(tmp_path / "h"))
    merged = H.scd2_merge(spark.read.parquet(str(tmp_path / "h")), frame(SCHEMA), "2024-01-05")
    plan = plan_of(merged)
    settled = plan[plan.rindex("LessThan(end_time") - 900:]
    assert "Exchange" not in settled


def test_rows_of_members_without_payment_are_not_shuffled(spark, tmp_path, frame):
    frame(SCHEMA, *[day_row(u, "2024-01-01", 1) for u in range(50)], day_row(7, "2024-01-05", 2)).write.parquet(str(tmp_path / "h"))
    frame(SCHEMA, day_row(3, "2024-01-05", 1)).write.parquet(str(tmp_path / "d"))
    history, delta = spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "d"))
    others, stored = H.split_by_delta(history, delta, "2024-01-05")
    assert {r.uid for r in stored.collect()} == {3, 7} and others.count() == 48
    plan = plan_of(others)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_daily_delta(frame):
    pay = frame("uid int, paymoney decimal(10,4), vip_id int, dt string, dn string",
                (1, Decimal(2), 1, "20240101", "w"), (1, Decimal(3), 2, "20240101", "w"), (1, Decimal(9), 1, "20240102", "w"),
                (2, None, 1, "20240101", "w"), (3, Decimal(9), 7, "20240101", "w"))
    vip = frame("vip_id int, vip_level string, dn string", (1, "l1", "w"), (2, "l2", "w"))
    assert rows_of(H.daily_payment_delta(pay, vip, "20240101")) == [
        (1, Decimal("5.0000"), "l2", "2024-01-01", "9999-12-31", "w"), (2, None, "l1", "2024-01-01", "9999-12-31", "w")]
