from __future__ import annotations

import os

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from coursemill.functions import cleaning as C
from coursemill.operators import mastery as K
from coursemill.operators import pages as P
from coursemill.operators import playback as PB
from coursemill.session import scratch_dir
from coursemill.plans import streams
from coursemill.sources.lines import json_lines_to_table, tsv_fields
from coursemill.sources.specs import ANSWER_TSV, REGISTER_TSV, spec
from coursemill.sources.streams import rate_limit, read_log_stream, replay_lines, row_bytes
from coursemill.streaming import jobs, learn
from coursemill.streaming.sinks import append_commits, compact, read_state
from coursemill.streaming.state import state_rows
from pyspark.sql.types import StructType


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def feed(spark, folder, lines, files=1):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(files).write.mode("append").text(folder)


def text_stream(spark, folder, per_batch=1):
    return read_log_stream(spark, "text", path=folder, cap={"maxFilesPerTrigger": str(per_batch)})


REGISTER = [f"{i}\t{i % 4}\tt" for i in range(30)] + ["only\ttwo", "1\t1\tt\textra", ""]
WANT = [("APP", 7), ("Other", 15), ("PC", 8)]


def apps(lines):
    return tsv_fields(lines, REGISTER_TSV).select(C.app_name(F.col("app_code")).alias("servicetype"))


@pytest.mark.parametrize("files", [1, 3])
def test_running_counts_do_not_depend_on_the_batches(spark, files):
    base = scratch_dir(spark, "run")
    feed(spark, f"{base}/in", REGISTER, files)
    finish(jobs.run_running_counts(apps(text_stream(spark, f"{base}/in")), "servicetype", f"{base}/cp"))
    assert rows_of(jobs.read_running_counts(spark, f"{base}/cp", "servicetype")) == WANT
    with pytest.raises(ValueError, match="state holds"):
        state_rows(spark, f"{base}/cp", ["servicetype"], ["a", "b"])


def test_running_counts_go_on_in_the_state_and_write_nothing_else(spark):
    base = scratch_dir(spark, "grow")
    for _ in range(3):
        feed(spark, f"{base}/in", REGISTER)
        finish(jobs.run_running_counts(apps(text_stream(spark, f"{base}/in")), "servicetype", f"{base}/cp"))
    assert rows_of(jobs.read_running_counts(spark, f"{base}/cp", "servicetype")) == [(k, 3 * n) for k, n in WANT]
    assert sorted(os.listdir(base)) == ["cp", "in"]


def test_commits_are_folded_and_old_ones_go(spark, frame):
    base = scratch_dir(spark, "fold")
    write = append_commits(base, ["k"], fold=3)
    for n in range(11):
        for _ in range(2 if n in (3, 9) else 1):  # a full commit that is repeated
            write(frame("k int, v int", (n % 4, n), (100 + n, n)), n)
    schema = StructType.fromDDL("k int, v int")
    assert rows_of(read_state(spark, base, ["k"], schema)) == sorted(
        [(0, 8), (1, 9), (2, 10), (3, 7), *((100 + n, n) for n in range(11))], key=lambda r: [(False, str(x)) for x in r])
    kept = sorted(int(d.split("=")[1]) for d in os.listdir(base) if "=" in d)
    assert kept == [6, 7, 8, 9, 10]


def test_restart_goes_on_from_the_checkpoint(spark):
    base = scratch_dir(spark, "restart")
    feed(spark, f"{base}/in", REGISTER[:10])
    run = lambda: finish(jobs.run_keyed_counts(apps(text_stream(spark, f"{base}/in")), f"{base}/t", f"{base}/cp"))
    run()
    run()  # nothing new
    feed(spark, f"{base}/in", REGISTER[10:], 2)
    run()
    got = read_state(spark, f"{base}/t", ["id"], jobs.APP_COUNTS)
    assert rows_of(got) == [(1, "PC", 8), (2, "APP", 7), (3, "Other", 15)]


def test_repeated_commit_overwrites_itself(spark, frame):
    base = scratch_dir(spark, "commit")
    write, df = append_commits(base), frame("k string, num bigint", ("a", 1))
    write(df, 0)
    write(frame("k string, num bigint", ("a", 3), ("b", 1)), 1)
    write(frame("k string, num bigint", ("a", 3), ("b", 1)), 1)
    assert spark.read.parquet(base).count() == 3
    assert rows_of(read_state(spark, base, ["k"], df.schema)) == [("a", 3), ("b", 1)]


def test_sliding_windows(spark):
    base = scratch_dir(spark, "win")
    feed(spark, f"{base}/in", ["1\t1\t2024-01-01 00:00:03", "2\t1\t2024-01-01 00:00:58", "3\t2\t2024-01-01 00:00:03"])
    stream = tsv_fields(text_stream(spark, f"{base}/in"), REGISTER_TSV).select(
        F.col("registered_at").cast("timestamp").alias("ts"), C.app_name(F.col("app_code")).alias("app"))
    finish(jobs.run_window_counts(stream, "ts", "app", f"{base}/out", f"{base}/cp"))
    got = jobs.read_windows(spark, f"{base}/out", "app")
    assert got.where("app = 'APP'").count() == 10
    at = got.where("app = 'PC'").select(F.date_format("window_start", "HH:mm:ss").alias("s"), "num")
    sums = dict(rows_of(at))
    assert sums["00:00:00"] == 2 and sums["23:59:12"] == 1 and sums["00:00:54"] == 1 and sum(sums.values()) == 20


def test_late_rows_count_in_whatever_batch_they_come(spark):
    base = scratch_dir(spark, "late")
    for i, t in enumerate(["05:00:00", "06:00:00", "00:00:00"]):
        feed(spark, f"{base}/in", [f"{i}\t1\t2024-01-01 {t}"])
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/in")
    stream = tsv_fields(lines, REGISTER_TSV).select(
        F.col("registered_at").cast("timestamp").alias("ts"), C.app_name(F.col("app_code")).alias("app"))
    finish(jobs.run_window_counts(stream, "ts", "app", f"{base}/out", f"{base}/cp"))
    got = jobs.read_windows(spark, f"{base}/out", "app")
    assert got.agg(F.sum("num")).first()[0] == 30
    once = jobs.window_counts(tsv_fields(spark.read.text(f"{base}/in"), REGISTER_TSV).select(
        F.col("registered_at").cast("timestamp").alias("ts"), C.app_name(F.col("app_code")).alias("app")), "ts", "app")
    assert rows_of(got) == rows_of(once)


def test_closed_windows_are_written_once(spark):
    base = scratch_dir(spark, "closed")
    at = ["00:00:03", "00:00:03", "00:00:59", "02:00:00", "04:00:00"]
    for i, t in enumerate(at):
        feed(spark, f"{base}/in", [f"{i}\t1\t2024-01-01 {t}"])
    stream = tsv_fields(text_stream(spark, f"{base}/in"), REGISTER_TSV).select(
        F.col("registered_at").cast("timestamp").alias("ts"), C.app_name(F.col("app_code")).alias("app"))
    finish(jobs.run_closed_windows(stream, "ts", "app", f"{base}/out", f"{base}/cp"))
    got = spark.read.schema("window_start timestamp, window_end timestamp, app string, num bigint, dt string").parquet(f"{base}/out")
    sums = [r[0] for r in got.groupBy("window_start", "app").count().select("count").collect()]
    assert sums and set(sums) == {1}  # no window twice
    early = got.where("window_start < '2024-01-01 01:00:00'").agg(F.sum("num")).first()[0]
    assert early == 30  # three rows in ten windows each; the last windows are still open


def test_graceful_stop_with_a_timed_trigger(spark):
    from coursemill.streaming.sinks import stop_gracefully
    base = scratch_dir(spark, "stop")
    feed(spark, f"{base}/in", REGISTER)
    query = jobs.run_running_counts(apps(text_stream(spark, f"{base}/in")), "servicetype", f"{base}/cp",
                                    trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    stop_gracefully(query)
    assert not query.isActive and query.exception() is None
    assert jobs.read_running_counts(spark, f"{base}/cp", "servicetype").count() == 3


LEARN = "userid bigint, cwareid bigint, videoid string, chapterid int, edutypeid int, sourceType string, subjectid int, ts bigint, te bigint, ps bigint, pe bigint"


def learn_file(spark, base, files):
    rows = [(None if i % 50 == 7 else i % 3, i % 2, f"v{i % 2}", i % 4, i % 2, "s", i % 5, i * 10, i * 10 + 1000 * (i % 7 + 1), (i * 37) % 100,
             (i * 37) % 100 + i % 19) for i in range(200)]
    df = spark.createDataFrame(rows + rows[:9], LEARN)
    df.repartition(files).write.parquet(f"{base}/in")
    return df


def learned(spark, base, df, name):
    return read_state(spark, f"{base}/out/{name}", learn.TABLES[name][0], learn.table_schema(df, name))


def learn_stream(spark, base, df):
    return read_log_stream(spark, "parquet", path=f"{base}/in", schema=df.schema, cap={"maxFilesPerTrigger": "1"})


def check_learned(spark, base, df):
    assert rows_of(learned(spark, base, df, "video_learn_detail")) == rows_of(PB.play_durations(df))
    assert rows_of(learned(spark, base, df, "video_interval")) == rows_of(PB.play_intervals_text(df))
    assert rows_of(learned(spark, base, df, "play_time")) == rows_of(PB.play_time_all(df))


@pytest.mark.parametrize("files", [1, 4])
def test_learning_stream_equals_batch_however_plays_are_dealt_to_batches(spark, files):
    base = scratch_dir(spark, "cov")
    df = learn_file(spark, base, files)
    finish(learn.run_learn(spark, learn_stream(spark, base, df), f"{base}/out", f"{base}/cp"))
    check_learned(spark, base, df)


def test_no_python_in_the_plan_of_the_learning_stream(spark, frame):
    df = frame(LEARN, (1, 1, "v", 1, 1, "s", 1, 0, 1000, 0, 5))
    ranges = learn.learn_groups(df).where("dimension IS NULL")
    for part in (ranges, PB.interval_texts(ranges), PB.durations_of(ranges)):
        assert "Python" not in plan_of(part) and "Pandas" not in plan_of(part)


def test_a_batch_that_failed_between_two_tables_changes_nothing_twice(spark, monkeypatch):
    base = scratch_dir(spark, "fail")
    df = learn_file(spark, base, 3)
    real, broken = learn.append_commits, {"at": 1}

    def failing(path, keys):
        write = real(path, keys)

        def each(batch, number):
            if path.endswith("video_learn_detail") and number == broken["at"]:
                raise RuntimeError("lost between two tables")
            write(batch, number)
        return each
    monkeypatch.setattr(learn, "append_commits", failing)
    with pytest.raises(Exception, match="lost between two tables"):
        learn.run_learn(spark, learn_stream(spark, base, df), f"{base}/out", f"{base}/cp").awaitTermination()
    assert rows_of(learned(spark, base, df, "video_interval").select("userid")) != []
    broken["at"] = -1
    finish(learn.run_learn(spark, learn_stream(spark, base, df), f"{base}/out", f"{base}/cp"))
    check_learned(spark, base, df)


def test_play_totals_stream_equals_batch(spark):
    base = scratch_dir(spark, "tot")
    df = learn_file(spark, base, 3)
    finish(jobs.run_play_totals(learn_stream(spark, base, df), f"{base}/cp"))
    assert rows_of(jobs.read_play_totals(spark, f"{base}/cp")) == rows_of(PB.play_time_all(df))


@pytest.mark.parametrize("files", [1, 3])
def test_mastery_stream_writes_detail_and_history(spark, files):
    base = scratch_dir(spark, "mas")
    feed(spark, f"{base}/in", [f"{i % 3}\t1\t{i % 2}\tq{i % 7}\t{i % 2}\tt{i:03d}" for i in range(60)] + ["bad"], files)
    rows = tsv_fields(spark.read.text(f"{base}/in"), ANSWER_TSV)
    finish(jobs.run_point_mastery(spark, tsv_fields(text_stream(spark, f"{base}/in"), ANSWER_TSV), f"{base}/out", f"{base}/cp"))
    want = K.point_mastery(rows)
    stored = read_state(spark, f"{base}/out/qz_point_detail", K.POINT, StructType([*want.schema.fields]).add("updatetime", "string"))
    assert rows_of(stored.drop("updatetime")) == rows_of(want)
    assert all(len(r["updatetime"]) == 19 for r in stored.select("updatetime").collect())
    history = read_state(spark, f"{base}/out/qz_point_history", K.POINT, StructType([*K.questions_from_counts(K.answer_counts(rows)).schema.fields]))
    assert rows_of(history) == rows_of(K.questions_from_counts(K.answer_counts(rows)))


def test_a_batch_writes_only_the_points_it_answers(spark):
    base = scratch_dir(spark, "few")
    run = lambda: finish(jobs.run_point_mastery(spark, tsv_fields(text_stream(spark, f"{base}/in"), ANSWER_TSV), f"{base}/out", f"{base}/cp"))
    feed(spark, f"{base}/in", [f"{u}\t1\t1\tq{q}\t1\tt" for u in range(5) for q in range(4)])
    run()
    feed(spark, f"{base}/in", ["3\t1\t1\tq9\t0\tt"])
    run()
    detail = spark.read.parquet(f"{base}/out/qz_point_detail")
    assert rows_of(detail.where("_commit_ts = 1"), "userid", "qz_sum", "qz_count", "qz_istrue") == [("3", 5, 5, 4)]
    assert detail.where("_commit_ts = 0").count() == 5


def test_page_stream_counts_and_regions(spark, frame):
    base = scratch_dir(spark, "page")
    lines = ['{"page_id": "%d", "last_page_id": "%d", "next_page_id": "%d", "ip": "0.0.%d.1"}' % (i % 3 + 1, i % 2, i % 4, i % 5)
             for i in range(40)] + ["{broken", "[]", ""]
    feed(spark, f"{base}/in", lines, 3)
    page = lambda df: json_lines_to_table(df, spec("page_event"))
    batch = P.page_transition_count(page(spark.read.text(f"{base}/in")))
    finish(jobs.run_page_transitions(spark, page(text_stream(spark, f"{base}/in")), f"{base}/out", f"{base}/cp"))
    want = P.page_jump_rate(batch)
    state = read_state(spark, f"{base}/out", P.TRIPLE, want.schema)
    assert rows_of(state) == rows_of(want) and {r["jump_rate"] for r in want.where("page_id = '2'").collect()} == {"93%"}
    assert rows_of(P.page_funnel(P.page_visit_total(state))) == [(1, 14, "100%"), (2, 13, "93%"), (3, 13, "100%")]

    ranges = frame("lo bigint, hi bigint, region string", (0, 255, "c|0|p0|t|i"), (256, 767, "c|0|p1|t|i"), (768, 1023, "c|0|p3|t|i"))
    finish(jobs.run_region_topk(spark, page(text_stream(spark, f"{base}/in")), ranges, f"{base}/tot", f"{base}/top", f"{base}/cp2"))
    assert rows_of(read_state(spark, f"{base}/tot", ["province"], StructType.fromDDL("province string, num bigint"))) == [("0", 8), ("p0", 8), ("p1", 16), ("p3", 8)]
    assert rows_of(spark.read.parquet(f"{base}/top")) == [("0", 8), ("p0", 8), ("p1", 16)]


def test_transitions_are_written_again_where_their_rate_has_moved(spark, frame):
    base = scratch_dir(spark, "moved")
    schema = StructType.fromDDL("last_page_id string, page_id string, next_page_id string")
    parts = [[("0", "1", "2")] * 2 + [("1", "2", "3")] + [("2", "3", "0")] + [("3", "4", "0")], [("0", "1", "5")] * 2]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = read_log_stream(spark, "parquet", path=f"{base}/in", schema=schema)
        finish(jobs.run_page_transitions(spark, stream, f"{base}/out", f"{base}/cp"))
    second = spark.read.parquet(f"{base}/out").where("_commit_ts = 1").drop("_commit_ts")
    assert rows_of(second) == [("0", "1", "5", 2, "100%"), ("1", "2", "3", 1, "25%")]
    want = P.page_jump_rate(P.page_transition_count(spark.createDataFrame(sum(parts, []), schema)))
    assert rows_of(read_state(spark, f"{base}/out", P.TRIPLE, want.schema)) == rows_of(want)


def test_landing_keeps_raw_values_by_topic_and_day(spark, frame):
    base = scratch_dir(spark, "land")
    frame("topic string, ts_ms bigint, value string", ("a", 0, "x"), ("b", 86_400_000, "{y"), ("a", 1, "")).write.parquet(f"{base}/in")
    schema = StructType.fromDDL("topic string, ts_ms bigint, value string")
    finish(jobs.run_land_raw(read_log_stream(spark, "parquet", path=f"{base}/in", schema=schema), f"{base}/out", f"{base}/cp"))
    got = spark.read.schema("value string, topic string, dt string").parquet(f"{base}/out")
    assert rows_of(got) == [("", "a", "19700101"), ("x", "a", "19700101"), ("{y", "b", "19700102")]


def test_replay_and_rate_limit(spark, tmp_path):
    (tmp_path / "log").write_text("a\nb\nc\n")
    replay_lines(spark, str(tmp_path / "log"), str(tmp_path / "out"), 2)
    assert rows_of(spark.read.text(str(tmp_path / "out"))) == [("a",), ("b",), ("c",)]
    assert rate_limit("kafka", 100, 10) == {"maxOffsetsPerTrigger": "3000"}
    assert rate_limit("text", 100, 2, 3, size=40.5) == {"maxBytesPerTrigger": "24300"}
    with pytest.raises(ValueError, match="size of a record"):
        rate_limit("text", 100)


def test_files_are_admitted_by_their_bytes(spark):
    base = scratch_dir(spark, "bytes")
    line = "x" * 99
    for n in [10] * 6 + [500, 500]:  # small files, then large ones
        feed(spark, f"{base}/in", [line] * n)
    size = row_bytes(spark, "text", f"{base}/in")
    assert size == 100
    sizes = []
    stream = read_log_stream(spark, "text", path=f"{base}/in", cap=rate_limit("text", 10, 1, 3, size))
    finish(stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count())).option("checkpointLocation", f"{base}/cp")
           .trigger(availableNow=True).start())
    assert sum(sizes) == 1060 and sorted(sizes)[-2:] == [500, 500] and max(sorted(sizes)[:-2]) <= 30


def test_rejects_of_a_stream_are_counted_while_it_is_read(spark):
    base = scratch_dir(spark, "rejects")
    feed(spark, f"{base}/in", REGISTER)
    query = tsv_fields(text_stream(spark, f"{base}/in"), REGISTER_TSV, observe="register").writeStream.format("noop").option(
        "checkpointLocation", f"{base}/cp").trigger(availableNow=True).start()
    finish(query)
    seen = [p["observedMetrics"]["register"] for p in query.recentProgress if "register" in p["observedMetrics"]]
    assert sum(m["lines"] for m in seen) == 33 and sum(m["rejected"] for m in seen) == 3


def test_text_files_land_as_topics_do(spark):
    base = scratch_dir(spark, "raw")
    feed(spark, f"{base}/in", ["x", "y"])
    streams.run(spark, "stream-land", base, f"{base}/in", once=True)
    got = spark.read.schema("value string, topic string, dt string").parquet(f"{base}/raw/logs")
    assert rows_of(got, "value", "topic") == [("x", "raw"), ("y", "raw")] and len(got.first()["dt"]) == 8


def test_jobs_run_from_log_files_to_their_tables(spark, frame):
    base = scratch_dir(spark, "jobs")
    play = '{"uid": %d, "cwareid": 1, "videoid": 2, "chapterid": 3, "edutypeid": 1, "subjectid": 1, "sourceType": "APP", "speed": 1, "ts": %d, "te": %d, "ps": %d, "pe": %d}'
    feed(spark, f"{base}/learn", [play % (i % 2, i * 1000, i * 1000 + 5000, i * 3, i * 3 + 5) for i in range(10)] + ["{bad"], 2)
    feed(spark, f"{base}/points", ["1\t1\t1\tq\t1\tt"])
    feed(spark, f"{base}/pages", ['{"page_id": "1", "last_page_id": "0", "next_page_id": "2", "ip": "0.0.0.1"}'])
    feed(spark, f"{base}/register", REGISTER)
    frame("lo bigint, hi bigint, region string", (0, 255, "c|0|p0|t|i")).write.parquet(f"{base}/dim/ip_region")
    for job, source in (("stream-learn", "learn"), ("stream-points", "points"), ("stream-pages", "pages"), ("stream-register", "register"),
                        ("stream-keyed", "register")):
        streams.run(spark, job, base, f"{base}/{source}", once=True)
    plays = json_lines_to_table(spark.read.text(f"{base}/learn"), spec("learn_event")).withColumnRenamed("uid", "userid")
    detail = read_state(spark, f"{base}/rt/learn/video_learn_detail", PB.VIDEO, learn.table_schema(plays, "video_learn_detail"))
    assert rows_of(detail) == rows_of(PB.play_durations(plays)) and detail.count() == 2
    assert spark.read.parquet(f"{base}/rt/points/qz_point_detail").select("qz_sum", "mastery_rate").collect()[0].qz_sum == 1
    assert spark.read.parquet(f"{base}/rt/page_jump_rate").first()["jump_rate"] == "100%"
    assert rows_of(spark.read.parquet(f"{base}/rt/top_city_num")) == [("p0", 1)]
    assert rows_of(jobs.read_running_counts(spark, f"{base}/_checkpoints/register_total", "servicetype")) == WANT
    assert rows_of(read_state(spark, f"{base}/rt/register_keyed", ["id"], jobs.APP_COUNTS), "servicetype", "count") == WANT


def test_a_stream_starts_with_a_rate_and_stops(spark):
    base = scratch_dir(spark, "started")
    feed(spark, f"{base}/in", ["1\t1\t1\tq\t1\tt"])
    query, = streams.start(spark, "stream-points", base, f"{base}/in")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{base}/rt/points/qz_point_detail").count() == 1
