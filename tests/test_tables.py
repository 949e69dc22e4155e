from __future__ import annotations

import base64

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coursemill.operators import keyed as K
from coursemill.operators import sinks as W
from coursemill.operators import versioned as V
from coursemill.operators.commits import write_commit
from coursemill.session import enable_compression, enable_dynamic_partitions, scratch_dir
from coursemill.sources import tables as T
from coursemill.sources.images import image_rows, read_images

SCHEMA = "id int, name string, count bigint"


@pytest.fixture
def keyed(spark, frame):
    path = scratch_dir(spark, "t")
    schema = frame(SCHEMA).schema
    assert not K.keyed_exists(spark, path)
    K.keyed_create(spark, path, schema)
    assert K.keyed_exists(spark, path) and K.read_keyed(spark, path, ["id"], schema).count() == 0
    K.apply_insert(spark, path, frame(SCHEMA, (1, "a", 1), (2, "b", 2), (3, "c", 3)), ["id"], schema)
    return path, schema


def test_insert_update_delete_upsert(spark, frame, keyed):
    path, schema = keyed
    read = lambda: rows_of(K.read_keyed(spark, path, ["id"], schema))
    K.apply_insert(spark, path, frame(SCHEMA, (1, "x", 9), (4, "d", 4)), ["id"], schema)
    assert read() == [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4)]
    K.apply_update(spark, path, frame("id int, name string", (2, "B"), (7, "no such row")), ["id"], schema)
    assert read() == [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", 4)]
    K.apply_upsert(spark, path, frame(SCHEMA, (3, None, 0), (5, "e", 5)), ["id"], schema)
    assert read() == [(1, "a", 1), (2, "B", 2), (3, None, 0), (4, "d", 4), (5, "e", 5)]
    K.apply_delete(spark, path, frame("id int, name string", *[(i, "") for i in (1, 2, 3, 4, 5, 6)]), ["id"], schema)
    assert read() == []
    K.apply_insert(spark, path, frame(SCHEMA, (1, "back", 1)), ["id"], schema)
    assert read() == [(1, "back", 1)]


def test_a_batch_is_added_once(spark, frame, keyed):
    path, schema = keyed
    batch = frame(SCHEMA, (1, "a", 10), (9, "n", 5))
    for number in (0, 0, 1, 0):
        K.apply_add(spark, path, batch, ["id"], ["count"], schema, number)
    assert rows_of(K.read_keyed(spark, path, ["id"], schema)) == [(1, "a", 21), (2, "b", 2), (3, "c", 3), (9, "n", 10)]


def test_a_change_writes_the_rows_it_makes_and_no_others(spark, frame, keyed):
    path, schema = keyed
    K.apply_upsert(spark, path, frame(SCHEMA, (2, "z", 1)), ["id"], schema)
    K.apply_delete(spark, path, frame("id int", (3,), (8,)), ["id"], schema)
    stored = spark.read.parquet(path)
    assert rows_of(stored.where("_commit_ts = 1"), "id", "name", K.DELETED) == [(2, "z", False)]
    assert rows_of(stored.where("_commit_ts = 2"), "id", K.DELETED) == [(3, True)]
    assert rows_of(K.read_keyed(spark, path, ["id"])) == [(1, "a", 1), (2, "z", 1)]


def test_many_changes_are_folded(spark, frame, keyed):
    path, schema = keyed
    for n in range(105):
        write_commit(frame(SCHEMA, (n % 3, f"v{n}", n)).withColumns({K.BATCH: F.lit(None).cast("bigint"), K.DELETED: F.lit(n % 3 == 2)}),
                     path, n + 2, ["id"])
    numbers = {r[0] for r in spark.read.parquet(path).select("_commit_ts").distinct().collect()}
    assert min(numbers) == 50 and len(numbers) == 57
    assert rows_of(K.read_keyed(spark, path, ["id"], schema)) == [(0, "v102", 102), (1, "v103", 103), (3, "c", 3)]


def test_repeated_keys_in_a_change_are_settled(frame):
    t = frame(SCHEMA, (1, "a", 1))
    rows = frame(SCHEMA, (1, "x", 5), (1, "y", 4), (2, "p", 1), (2, "p", 1))
    assert rows_of(K.keyed_upsert(t, rows, ["id"])) == [(1, "y", 4), (2, "p", 1)]
    assert rows_of(K.keyed_update(t, rows, ["id"])) == [(1, "y", 4)]


def test_keyed_filters_reach_the_files(spark, frame, keyed):
    path, schema = keyed
    read = K.read_keyed(spark, path, ["id"], schema)
    assert "EqualTo(id,1)" in plan_of(read.where("id = 1"))
    # A row that an older commit holds under another name must not come back, so other filters wait for the newest row.
    K.apply_upsert(spark, path, frame(SCHEMA, (1, "new", 1)), ["id"], schema)
    assert K.read_keyed(spark, path, ["id"], schema).where("name = 'a'").count() == 0


# --- versioned ------------------------------------------------------------------------

LAKE = "uid int, ts string, name string, part string"


def test_snapshot_incremental_and_between(spark, frame):
    path = scratch_dir(spark, "v")
    V.versioned_insert(frame(LAKE, (1, "10", "a", "p"), (1, "11", "b", "p"), (2, "10", "c", "p")), path, ["uid"], "ts", 100)
    V.versioned_upsert(frame(LAKE, (1, "11", "tie", "p"), (3, "12", "d", "q")), path, ["uid"], "ts", 200)
    V.versioned_upsert(frame(LAKE, (2, "09", "older", "p"), (3, "13", "e", "p")), path, ["uid"], "ts", 300)
    V.versioned_upsert(frame(LAKE, (2, "09", "older", "p"), (3, "13", "e", "p")), path, ["uid"], "ts", 300)  # repeated
    cols = ("uid", "name", V.COMMIT)
    assert rows_of(V.read_snapshot(spark, path, ["uid"], "ts"), *cols) == [(1, "tie", 200), (2, "c", 100), (3, "e", 300)]
    assert rows_of(V.read_incremental(spark, path, ["uid"], "ts", 200), *cols) == [(3, "e", 300)]  # 2 is outranked
    assert rows_of(V.read_between(spark, path, ["uid"], "ts", 100, 200), *cols) == [(1, "tie", 200), (3, "d", 200)]
    plan = plan_of(V.read_between(spark, path, ["uid"], "ts", 100, 200))
    assert "PartitionFilters: [isnotnull(_commit_ts" in plan and "WindowGroupLimit" in plan
    V.versioned_insert(frame(LAKE, (9, "1", "z", "p")), path, ["uid"], "ts", 400)
    assert V.read_snapshot(spark, path, ["uid"], "ts").count() == 1


def test_rows_without_partition_stay_and_names_stay_text(spark, frame):
    path = scratch_dir(spark, "cow")
    V.cow_upsert(spark, frame("uid int, ts string, name string, dn string", (1, "10", "a", None), (2, "10", "b", ""), (3, "10", "c", "007")), path, ["uid"], "ts", "dn", 1)
    V.cow_upsert(spark, frame("uid int, ts string, name string, dn string", (4, "10", "d", None)), path, ["uid"], "ts", "dn", 2)
    assert rows_of(T.read_folder(spark, path).where("not _empty"), "uid", "dn") == [(1, None), (2, None), (3, "007"), (4, None)]


@pytest.mark.parametrize("commits", [2, 3])
def test_both_layouts_hold_the_same_rows(spark, frame, commits):
    log, cow = scratch_dir(spark, "log"), scratch_dir(spark, "cow")
    frames = [frame(LAKE, *[(u, f"{(u * 7 + c * 5) % 23:02d}", f"n{c}", f"p/{(u + c) % 3}") for u in range(c, 12 + c)])
              for c in range(commits)]
    for c, df in enumerate(frames):
        V.versioned_upsert(df, log, ["uid"], "ts", c)
        V.cow_upsert(spark, df, cow, ["uid"], "ts", "part", c)
    stored = V.read_cow(spark, cow, frames[0].schema.add(V.COMMIT, "long"))
    cols = [*frames[0].schema.names[:4], V.COMMIT]
    assert rows_of(stored, *cols) == rows_of(V.read_snapshot(spark, log, ["uid"], "ts"), *cols)


def test_a_moved_key_leaves_its_partition_empty(spark, frame):
    path = scratch_dir(spark, "move")
    V.cow_upsert(spark, frame(LAKE, (1, "1", "a", "x/y"), (2, "1", "b", "z")), path, ["uid"], "ts", "part", 1)
    V.cow_upsert(spark, frame(LAKE, (1, "2", "a", "z")), path, ["uid"], "ts", "part", 2)
    rows = V.read_cow(spark, path, StructType.fromDDL(LAKE).add(V.COMMIT, "long"))
    assert rows_of(rows, "uid", "part") == [(1, "z"), (2, "z")]


def test_lake_columns(frame):
    got = V.derive_partition_path(frame("uid int, dt string, dn string", (7, "20240101", "web")), "123").first()
    assert (got.ts, got.uuid, got.partitionpath) == ("123", 7, "20240101/web")


# --- sinks -------------------------------------------------------------------------------

def test_append_and_dynamic_overwrite(spark, frame):
    path = scratch_dir(spark, "w")
    df = frame("a int, dt string, dn string", (1, "20240101", "w"), (2, "20240102", "w"))
    W.write_append(df, path)
    W.write_append(df, path)
    W.write_overwrite(df.where("a = 2").withColumn("a", F.lit(5)), path)
    read = T.read_folder(spark, path)
    assert rows_of(read, "a", "dt", "dn") == [(1, "20240101", "w"), (1, "20240101", "w"), (5, "20240102", "w")]
    assert "PartitionFilters: [isnotnull(" in plan_of(T.partition_filter(read, "20240101"))
    W.replace_table(df.limit(0), path)
    assert spark.read.schema(df.schema).parquet(path).count() == 0


def test_compression_files_and_conf(spark, frame, tmp_path):
    enable_compression(spark)
    enable_dynamic_partitions(spark)
    W.write_append(W.limit_files(frame("a int, dt string, dn string", *[(i, "d", "w") for i in range(20)]), 3), str(tmp_path / "c"))
    files = [p.name for p in (tmp_path / "c").rglob("*.parquet")]
    assert len(files) == 3 and all("snappy" in f for f in files)


def test_spread_writes_one_file_per_small_folder(spark, tmp_path):
    df = spark.range(4000).repartition(8).select("id", (F.col("id") % 5).alias("p"))
    W.write_append(W.spread_for_partitions(df, ["p"]), str(tmp_path / "s"), ["p"])
    assert len(list((tmp_path / "s").rglob("*.parquet"))) == 5


def test_replaced_partitions_keep_odd_names(spark, tmp_path):
    values = ["a b", "x/y", "p=q", "50%", "c:d", "?*[", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    path = str(tmp_path / "n")
    W.replace_partitions(df, df, path, "v")
    W.replace_partitions(df.where("i < 3"), df.where("i < 5"), path, "v")
    got = W.read_partitions(spark.read.schema("i int, _empty boolean, v string").parquet(path))
    assert rows_of(got) == rows_of(df.where("i < 3 or i >= 5"))


def test_register_table(spark, frame):
    path = scratch_dir(spark, "reg")
    W.write_append(frame("a int, dt string, dn string", (1, "20240101", "007"), (2, "20240102", "w")), path)
    T.register_table(spark, path, "published")
    T.register_table(spark, path, "published")
    table = spark.table("published")
    assert dict(table.dtypes) == {"a": "int", "dt": "string", "dn": "string"}
    assert rows_of(table) == [(1, "20240101", "007"), (2, "20240102", "w")]
    assert rows_of(spark.sql("SELECT a FROM published WHERE dn = '007'")) == [(1,)]
    assert {c.name for c in spark.catalog.listColumns("published") if c.isPartition} == {"dt", "dn"}
    plain = scratch_dir(spark, "plain")
    frame("a int", (5,)).write.parquet(plain)
    T.register_table(spark, plain, "published_plain")
    assert rows_of(spark.table("published_plain")) == [(5,)]


def test_the_newest_row_of_a_key_by_an_order_column(frame):
    table = frame("id int, name string, ts int", (1, "a", 0), (3, "c", 0))
    rows = frame("id int, name string, ts int", (1, "z", 2), (1, "b", 9), (2, "y", 1), (2, "x", 1))
    for part in (rows, rows.orderBy("name")):
        assert rows_of(K.keyed_upsert(table, part, ["id"], ["ts"])) == [(1, "b", 9), (2, "y", 1), (3, "c", 0)]
        assert rows_of(K.keyed_update(table, part, ["id"], ["ts"])) == [(1, "b", 9), (3, "c", 0)]
    # The order column need not be one of the table.
    assert rows_of(K.keyed_upsert(table.drop("ts"), rows, ["id"], ["ts"])) == [(1, "b"), (2, "y"), (3, "c")]


def test_images(spark, tmp_path):
    png = base64.b64decode("iVBORw0KGgoAAAANSUhEUgAAAAEAAAABCAYAAAAfFcSJAAAADUlEQVR42mNk+M9QDwADhgGAWjR9awAAAABJRU5ErkJggg==")
    (tmp_path / "ok.png").write_bytes(png)
    (tmp_path / "broken.png").write_bytes(b"no image")
    rows = image_rows(read_images(spark, str(tmp_path)), "2024/01/01", "1").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.width, r.height, r.dt, r.ts) == (1, 1, "2024/01/01", "1") and r.uuid == r.origin and len(r.data) > 0


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        scratch_dir(Session(), "x")
