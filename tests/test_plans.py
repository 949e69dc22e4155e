"""Logs of every table, through all layers."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from coursemill.operators import joins as J
from coursemill.operators.member import DWS_MEMBER
from coursemill.operators.metrics import MEMBER_COUNTS
from coursemill.operators.versioned import read_snapshot
from coursemill.plans import detail, member, questions, sales
from coursemill.sources.specs import spec
from coursemill.sources.tables import partition_filter, read_table, scan, table_path

N, DAYS = 6, ("20240101", "20240102")


def value(table: str, name: str, kind: str, i: int, dt: str):
    special = {"dt": dt, "dn": "web", "phone": f"1380000{i:04d}", "regsource": str(i % 6), "istrue": str(i % 2)}
    if name in special:
        return special[name]
    if kind == "int":
        if table == "dwd_qz_member_paper_question" and name in ("paperviewid", "questionid"):
            return i % 2 + 1
        if table == "dwd_pcentermempaymoney" and name == "vip_id":
            return i % 3 + 1
        return i // 2 % 2 if name == "question_answer" else i
    if kind == "decimal" or name in ("paymoney", "discount", "sellmoney", "money"):
        return f"{i * 15}.25"
    if name in ("courseid", "orderid"):
        return str(i)
    return f"{name}-{i}"


def write_logs(ods) -> None:
    for table in detail.DETAIL_TABLES:
        if table in detail.LOG_OF_CLUSTER:
            continue
        s = spec(table)
        lines = ["", "{broken", "[1]"]
        for dt in DAYS if "dt" in s.columns else DAYS[:1]:
            for i in range(1, N + 1):
                row = {f.spellings[-1]: value(table, f.name, f.kind, i, dt) for f in s.fields}
                lines.append(json.dumps({**row, "discountval": "9"}))
        (ods / f"{table}.log").write_text("\n".join(lines))


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    ods, root = tmp_path_factory.mktemp("ods"), str(tmp_path_factory.mktemp("root"))
    write_logs(ods)
    for area in ("member", "questions", "sales"):
        detail.load_area(spark, str(ods), root, area)
    return str(ods), root


def member_reports_sql(spark, root, dt):
    """The member reports as SQL over the stored wide table."""
    partition_filter(read_table(spark, root, "dws.dws_member"), dt).createOrReplaceTempView("wide_of_day")
    out = {by: spark.sql(f"SELECT {by}, count(uid) AS num, dt, dn FROM wide_of_day GROUP BY {by}, dn, dt")
           for by in MEMBER_COUNTS.values()}
    out["top3"] = spark.sql("""
        SELECT uid, memberlevel, register, appregurl, regsourcename, adname, sitename, vip_level,
               CAST(paymoney AS decimal(20,4)) AS paymoney, rownum, dt, dn
        FROM (SELECT *, row_number() OVER (PARTITION BY dt, dn, memberlevel
                                           ORDER BY CAST(paymoney AS decimal(20,4)) DESC, uid) AS rownum
              FROM wide_of_day)
        WHERE rownum < 4 ORDER BY memberlevel, rownum""")
    return out


def question_reports_sql(spark, root, dt):
    """The question reports as SQL over the stored detail, one statement each."""
    questions.answer_detail(spark, root, dt).createOrReplaceTempView("answers_of_day")
    paper = "paperviewid, paperviewname, dt, dn"
    ranked = """SELECT userid, paperviewid, paperviewname, chaptername, pointname, sitecoursename, coursename, majorname,
                       shortname, papername, score, rk, dt, dn
                FROM (SELECT *, dense_rank() OVER (PARTITION BY paperviewid ORDER BY score {0}) AS rk FROM answers_of_day)
                WHERE rk < 4"""
    return {
        "ads_paper_avgtimeandscore": spark.sql(f"""
            SELECT paperviewid, paperviewname, CAST(avg(score) AS decimal(4,1)) AS avgscore,
                   CAST(avg(spendtime) AS decimal(10,1)) AS avgspendtime, dt, dn
            FROM answers_of_day GROUP BY {paper} ORDER BY avgscore DESC, avgspendtime DESC"""),
        "ads_paper_maxdetail": spark.sql(f"""
            SELECT paperviewid, paperviewname, CAST(max(score) AS decimal(4,1)) AS maxscore,
                   CAST(min(score) AS decimal(4,1)) AS minscore, dt, dn FROM answers_of_day GROUP BY {paper}"""),
        "ads_top3_userdetail": spark.sql(ranked.format("DESC")),
        "ads_low3_userdetail": spark.sql(ranked.format("ASC")),
        "ads_user_paper_detail": spark.sql(f"""
            SELECT paperviewid, paperviewname, unpasscount, passcount,
                   CAST(passcount / (passcount + unpasscount) AS decimal(4,2)) AS rate, dt, dn
            FROM (SELECT {paper}, count_if(score BETWEEN 0 AND 60) AS unpasscount, count_if(score > 60) AS passcount
                  FROM answers_of_day GROUP BY {paper}) WHERE unpasscount > 0 AND passcount > 0"""),
        "ads_user_question_detail": spark.sql("""
            SELECT questionid, errcount, rightcount, CAST(errcount / (errcount + rightcount) AS decimal(4,2)) AS rate, dt, dn
            FROM (SELECT questionid, dt, dn, count_if(user_question_answer = 0) AS errcount,
                         count_if(user_question_answer = 1) AS rightcount
                  FROM answers_of_day GROUP BY questionid, dt, dn)
            WHERE errcount > 0 AND rightcount > 0 ORDER BY errcount DESC"""),
    }


def test_detail_tables_hold_the_good_lines(spark, warehouse):
    _, root = warehouse
    for table in detail.DETAIL_TABLES:
        s = spec(table)
        rows = read_table(spark, root, f"dwd.{table}")
        assert set(rows.columns) == set(s.columns), table
        assert rows.count() == N * (len(DAYS) if "dt" in s.columns else 1), table


def test_lookups_are_replaced_and_logs_appended(spark, warehouse, tmp_path):
    ods, _ = warehouse
    root = str(tmp_path)
    for _ in range(2):
        detail.load_detail(spark, ods, root, "dwd_base_ad")
        detail.load_detail(spark, ods, root, "dwd_member", files=2)
    assert read_table(spark, root, "dwd.dwd_base_ad").count() == N
    assert read_table(spark, root, "dwd.dwd_member").count() == 2 * N * len(DAYS)


def test_member_area(spark, warehouse):
    _, root = warehouse
    for dt in DAYS:
        member.build_member_wide(spark, root, dt)
        member.build_member_reports(spark, root, dt)
    wide = read_table(spark, root, "dws.dws_member")
    assert set(wide.columns) == set(DWS_MEMBER) and wide.count() == N * 2
    one = wide.where("uid = 3 and dt = '20240101'").first()
    # two registration rows and two payments of 45.25, each matched by one vip level
    assert one.paymoney == Decimal("181.0000") and one.fullname == "fxx" and one.password == "******"
    assert one.vip_level is not None and one.siteid == 3

    sql = member_reports_sql(spark, root, DAYS[0])
    for by, table in member.COUNT_TABLES.items():
        stored = read_table(spark, root, f"ads.{table}").where(F.col("dt") == DAYS[0])
        assert rows_of(stored, by, "num", "dt", "dn") == rows_of(sql[by], by, "num", "dt", "dn")
    cols = ["uid", "memberlevel", "rownum", "vip_level"]
    top = read_table(spark, root, f"ads.{member.TOP_TABLE}").where(F.col("dt") == DAYS[0])
    assert rows_of(top, *cols) == rows_of(sql["top3"], *cols)

    before = read_table(spark, root, f"ads.{member.TOP_TABLE}").count()
    member.build_member_reports(spark, root, DAYS[0])  # again: replaced, not doubled
    assert read_table(spark, root, f"ads.{member.TOP_TABLE}").count() == before


def test_member_history(spark, warehouse):
    _, root = warehouse
    for dt in (*DAYS, DAYS[0], DAYS[1]):  # each day twice
        member.build_member_history(spark, root, dt)
    rows = rows_of(member.read_member_history(spark, root).where("uid = 2"), "start_time", "end_time", "paymoney")
    assert rows == [("2024-01-01", "2024-01-02", Decimal("30.2500")), ("2024-01-02", "9999-12-31", Decimal("60.5000"))]
    # vip level 1 to 3 exist for all members
    assert member.read_member_history(spark, root).count() == 2 * N


def test_question_area(spark, warehouse):
    _, root = warehouse
    dt = DAYS[0]
    questions.build_question_wide(spark, root, dt)
    columns = {"dws_qz_chapter": J.QZ_CHAPTER, "dws_qz_course": J.QZ_COURSE, "dws_qz_major": J.QZ_MAJOR,
               "dws_qz_paper": J.QZ_PAPER, "dws_qz_question": J.QZ_QUESTION}
    for table, cols in columns.items():
        rows = read_table(spark, root, f"dws.{table}")
        assert set(rows.columns) == set(cols) and rows.count() == N, table
    chapter = read_table(spark, root, "dws.dws_qz_chapter").first()
    assert chapter.status.startswith("status-") and chapter.showstatus.startswith("showstatus-")

    questions.build_answer_detail(spark, root, dt)
    rows = questions.answer_detail(spark, root, dt)
    assert set(rows.columns) == set(J.ANSWER_DETAIL) and rows.count() == N
    assert rows_of(rows.where("userid = 3"), "score", "user_question_answer", "spendtime") == [(Decimal("45.3"), 1, 3)]

    questions.build_question_reports(spark, root, dt)
    for table, want in question_reports_sql(spark, root, dt).items():
        got = read_table(spark, root, f"ads.{table}")
        assert rows_of(got, *want.columns) == rows_of(want), table
    bands = read_table(spark, root, "ads.ads_paper_scoresegment_user")
    ids = sorted(i for r in bands.collect() for i in r.userids.split(","))
    assert ids == [str(i) for i in range(1, N + 1)]


def test_sales_area(spark, warehouse):
    _, root = warehouse
    results = {}
    for form in sales.FORMS:
        sales.build_sales_detail(spark, root, DAYS[0], form)
        rows = read_table(spark, root, "dws.dws_salecourse_detail")
        assert set(rows.columns) == set(J.SALES_DETAIL)
        results[form] = rows_of(rows, *J.SALES_DETAIL)
    assert len(results["plain"]) == N and all(r == results["plain"] for r in results.values())
    assert all(None not in r for r in results["plain"])


def test_lake_member(spark, warehouse, tmp_path):
    ods, _ = warehouse
    path = str(tmp_path / "lake")
    detail.load_lake_member(spark, f"{ods}/dwd_member.log", path, 20240101000000, first=True)
    detail.load_lake_member(spark, f"{ods}/dwd_member.log", path, 20240102000000)
    now = read_snapshot(spark, path, ["uuid"], "ts")
    assert now.count() == N and {r.ts for r in now.collect()} == {"20240102000000"}


def test_named_scan_prunes_columns_and_days(spark, warehouse):
    _, root = warehouse
    df = scan(spark, root, "member_regtype", DAYS[0]).select("uid", "siteid")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<uid:bigint,websiteid:bigint>" in plan and "PartitionFilters: [isnotnull(dt" in plan
    assert table_path(root, "dwd.x").endswith("/dwd/x")
