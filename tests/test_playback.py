from __future__ import annotations

import random

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from coursemill.operators import mastery as K
from coursemill.operators import playback as P

LEARN = "event_id bigint, userid bigint, cwareid bigint, videoid string, ps bigint, pe bigint, ts bigint, te bigint"


def learn_rows(frame, *ranges, video="v"):
    return frame(LEARN, *[(i, 1, 1, video, s, e, 0, (e - s) * 2000 + 500) for i, (s, e) in enumerate(ranges)])


def union_seconds(ranges):
    return {x for s, e in ranges for x in range(s, e)}


CASES = [
    [(0, 10)], [(0, 10), (20, 30)], [(0, 10), (10, 20)], [(0, 30), (5, 9)], [(5, 15), (0, 10)], [(0, 10), (5, 15)],
    [(0, 10), (0, 20)], [(5, 10), (0, 10)], [(0, 10), (0, 10)], [(3, 3)], [(0, 10), (4, 4)],
]
CASES += [[(s, s + n) for s, n in ((random.Random(k * 31 + j).randint(0, 60), random.Random(k * 57 + j).randint(1, 20))
                                   for j in range(12))] for k in range(4)]


@pytest.mark.parametrize("ranges", CASES)
def test_coverage_against_a_set_of_seconds(frame, ranges):
    df = learn_rows(frame, *ranges)
    seen: set = set()
    fresh = {}
    for i, (s, e) in sorted(enumerate(ranges), key=lambda x: (x[1], x[0])):
        fresh[i] = len(set(range(s, e)) - seen)
        seen |= set(range(s, e))
    assert {r.event_id: r.fresh for r in P.play_coverage(df).collect()} == fresh
    d = P.play_durations(df).first()
    assert d.completetime == len(union_seconds(ranges)) and d.totaltime == sum(2 * (e - s) for s, e in ranges)
    assert d.effecttime <= d.totaltime
    text = P.play_intervals_text(df).first().play_interval
    merged = [tuple(map(int, p.split("-"))) for p in text.split(",")]
    assert union_seconds(merged) == union_seconds(ranges)
    assert merged == sorted(merged) and all(a[1] < b[0] for a, b in zip(merged, merged[1:]))


def test_effective_seconds_scale_with_the_new_share(frame):
    df = frame(LEARN, (1, 1, 1, "v", 0, 10, 0, 20_999), (2, 1, 1, "v", 5, 15, 0, 7_000), (3, 1, 1, "v", 8, 8, 0, 5_000))
    d = P.play_durations(df).first()
    assert (d.totaltime, d.effecttime, d.completetime) == (20 + 7 + 5, 20 + 3, 15)  # floor(7 / 10 * 5) = 3


def test_repeats_of_a_range_fold_before_the_shuffle(frame):
    df = learn_rows(frame, *[(0, 10)] * 50, (0, 11))
    folded = P.fresh_ranges(df).collect()
    assert len(folded) == 2 and sorted(r.plays for r in folded) == [1, 50]


def test_play_time_reports_agree_with_the_single_pass(frame):
    df = frame("chapterid int, cwareid int, edutypeid int, sourceType string, subjectid int, ts bigint, te bigint",
               *[(i % 2, i % 3, i % 4, f"s{i % 2}", i % 5, 1000 * i, 1000 * i + 1999 + i * 1000) for i in range(20)])
    want = {(by, str(r[0])): r.totaltime for by in P.PLAY_TIMES.values() for r in P.play_time(df, by).collect()}
    assert {(r.dimension, r.id): r.totaltime for r in P.play_time_all(df).collect()} == want


LOG = "userid int, cwareid int, videoid int, chapterid int, ps int, pe int, ts bigint, te bigint"


def test_plays_without_an_event_id_count_in_order_of_time_and_content(frame):
    rows = [(1, 1, 1, 5, 0, 10, 2000, 9_000), (1, 1, 1, 4, 0, 10, 0, 5_000), (1, 1, 1, 4, 0, 10, 0, 5_000), (None, 1, 1, 4, 2, 4, 0, 1_000)]
    for part in (rows, rows[::-1]):
        got = rows_of(P.play_coverage(frame(LOG, *part)), "userid", "chapterid", "plays", "fresh")
        assert got == [(1, 4, 2, 10), (1, 5, 1, 0), (None, 4, 1, 2)]
        assert rows_of(P.play_durations(frame(LOG, *part)).where("userid = 1")) == [(1, 1, 1, 5 + 5 + 7, 5, 10)]


def test_equal_times_are_put_in_order_by_content(frame):
    rows = [(1, 1, 1, c, 0, 10, 0, 5_000) for c in range(5)]
    first = [r for r in P.play_coverage(frame(LOG, *rows)).collect() if r.fresh]
    again = [r for r in P.play_coverage(frame(LOG, *rows[::-1]).repartition(3)).collect() if r.fresh]
    assert len(first) == 1 and first == again


@pytest.mark.parametrize("log", [False, True])
def test_coverage_broadcasts_no_side_however_small_it_looks(spark, log):
    e = F.col("id")
    plays = spark.range(200).select(e.alias("event_id"), (e % 3).alias("userid"), (e % 2).alias("cwareid"), (e % 5).alias("videoid"),
                                    (e % 7).alias("ps"), (e % 7 + 4).alias("pe"), e.alias("ts"), (e + 9000).alias("te"))
    got = P.play_coverage(plays.drop("event_id") if log else plays)
    assert "BroadcastHashJoin" not in plan_of(got) and "SortMergeJoin" in plan_of(got)
    assert got.count() == 200


# --- mastery ----------------------------------------------------------------------------

ANSWER = "userid int, courseid int, pointid int, questionid string, istrue string, createtime string"


def test_point_mastery(frame):
    df = frame(ANSWER, (1, 1, 1, "a", "1", "t2"), (1, 1, 1, "a", "0", "t1"), (1, 1, 1, "b", "1", "t3"), (1, 1, 2, "a", "0", "t1"))
    got = {r.pointid: r for r in K.point_mastery(df).collect()}
    r = got[1]
    assert (r.qz_sum, r.qz_count, r.qz_istrue, r.createtime) == (3, 2, 2, "t1")
    assert r.correct_rate == 2 / 3 and r.mastery_rate == 2 / 30 * (2 / 3)
    assert got[2].mastery_rate == 0.0


def test_counts_of_two_batches_add_up(frame):
    from coursemill.operators.keyed import keyed_add
    rows = [(1, 1, 1, "abc"[i % 3], str(i % 2), f"t{i}") for i in range(10)]
    a, b = K.answer_counts(frame(ANSWER, *rows[:4])), K.answer_counts(frame(ANSWER, *rows[4:]))
    keys = [*K.POINT, "questionid"]
    both = keyed_add(a.drop("createtime"), b.drop("createtime"), keys, ["qz_sum", "qz_istrue"])
    assert rows_of(both, *keys, "qz_sum", "qz_istrue") == rows_of(
        K.answer_counts(frame(ANSWER, *rows)), *keys, "qz_sum", "qz_istrue")


def test_question_lists_explode_back(frame):
    from pyspark.sql import functions as F

    from coursemill.functions.scalars import text_to_ids
    df = frame(ANSWER, *[(1, 1, 1, q, "1", "t") for q in "bab"])
    lists = K.point_questions(df)
    assert lists.first().questionids == "a,b"
    again = K.explode_groups(lists.withColumn("q", text_to_ids(F.col("questionids"))), "q")
    assert rows_of(again, "q") == [("a",), ("b",)]
