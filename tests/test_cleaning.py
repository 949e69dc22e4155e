from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from coursemill.functions import cleaning as C
from coursemill.functions import scalars as S
from coursemill.sources.lines import (bad_field_counts, bad_json_lines, drop_bad_json, json_lines_to_table,
                                      read_lines, tsv_fields)
from coursemill.sources.specs import FIELDS, SCANS, spec
from coursemill.sources.tables import parse_columns


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize("text,want", [("12", 12), ("-3", -3), ("12.7", 12), (" 5 ", 5), ("abc", 0), ("", 0),
                                       (None, 0), ("99999999999", 99999999999), ("1" + "0" * 30, 0)])
def test_int_or_zero(spark, text, want):
    assert one(spark, C.int_or_zero(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text,want", [("12.25", "12.3"), ("12.24", "12.2"), ("-0.05", "-0.1"), ("7", "7.0"),
                                       ("x", None), (None, None)])
def test_decimal_half_up(spark, text, want):
    got = one(spark, C.decimal_half_up(F.lit(text).cast("string")))
    assert got == (None if want is None else Decimal(want))


def test_masks(spark):
    phone = lambda p: one(spark, C.mask_phone(F.lit(p).cast("string")))
    assert phone("13812345678") == "138*****5678"
    assert phone("138123") is None and phone(None) is None
    name = lambda n: one(spark, C.mask_name(F.lit(n).cast("string")))
    assert name("Wang") == "Wxx" and name("") is None and name(None) is None


@pytest.mark.parametrize("code,want", [("1", "PC"), ("2", "Mobile"), ("3", "App"), ("4", "WeChat"), ("5", "other"),
                                       (None, "other")])
def test_code_map(spark, code, want):
    assert one(spark, C.register_source_name(F.lit(code).cast("string"))) == want


LINES = ['{"uid": 1, "fullname": "Li"}', "", "   ", "[1,2]", '[{"uid": 9}]', '"x"', "null", "{bad", "7", "{}"]


def lines_df(frame, lines):
    return frame("value string", *[(x,) for x in lines])


def test_drop_bad_json_keeps_objects_only(frame):
    got = drop_bad_json(lines_df(frame, LINES), ["uid", "fullname"])
    assert rows_of(got) == [("1", "Li"), (None, None)]


def test_rejected_lines_are_counted_while_they_are_read(spark, frame):
    seen = Observation()
    rows = drop_bad_json(lines_df(frame, LINES), ["a"], observe=seen)
    kept, bad = rows.count(), bad_json_lines(lines_df(frame, LINES)).count()
    assert seen.get == {"lines": kept + bad, "rejected": bad} and bad > 0
    assert plan_of(drop_bad_json(lines_df(frame, LINES), ["a"], observe=Observation())).count("Scan") == 1


def test_bad_json_lines_are_the_rest(frame):
    got = {r[0] for r in rows_of(bad_json_lines(lines_df(frame, LINES)))}
    assert got == {"[1,2]", '[{"uid": 9}]', '"x"', "null", "{bad", "7"}


def test_json_is_parsed_once(frame):
    plan = drop_bad_json(lines_df(frame, LINES), ["uid"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_member_table(frame):
    line = ('{"uid": "7", "ad_id": 3, "fullname": "Zhang", "phone": "13812345678", "password": "p", "paymoney": 12.5,'
            ' "dt": "20240101", "dn": "web"}')
    row = json_lines_to_table(lines_df(frame, [line, "{bad"]), spec("dwd_member")).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.uid, r.ad_id, r.fullname, r.phone, r.password, r.paymoney, r.qq) == (
        7, 3, "Zxx", "138*****5678", "******", "12.5", None)
    assert row[0].__fields__[-2:] == ["dt", "dn"]


def test_either_spelling_is_read(frame):
    for key in ("sequence", "sequece"):
        got = json_lines_to_table(lines_df(frame, ['{"%s": "4", "score": "2.25"}' % key]), spec("dwd_qz_point"))
        assert rows_of(got, "sequence", "score", "pointid") == [("4", Decimal("2.3"), 0)]
    got = json_lines_to_table(lines_df(frame, ['{"createitme": "t"}']), spec("dwd_course_pay_cluster"))
    assert rows_of(got, "createtime") == [("t",)]


def test_page_event_has_no_nulls(frame):
    got = json_lines_to_table(lines_df(frame, ['{"uid": 5, "page_id": null}']), spec("page_event"))
    assert rows_of(got) == [("5", "", "", "", "", "", "")]


def test_bad_field_counts(frame):
    lines = lines_df(frame, ['{"uid": "x", "ad_id": 1}', '{"uid": 2}', '{"uid": "y", "ad_id": "z"}'])
    assert bad_field_counts(lines, spec("dwd_member")).first().asDict() == {"ad_id": 1, "uid": 2}


@pytest.mark.parametrize("line,keep", [("a\tb", False), ("a\tb\tc", True), ("a\tb\tc\t", True), ("a\tb\tc\td", False),
                                       ("a\t\tc", True), ("a\tb\t", False), ("", False)])
def test_tsv_fields(frame, line, keep):
    assert tsv_fields(lines_df(frame, [line]), ["x", "y", "z"]).count() == int(keep)


def test_tsv_six_fields(frame):
    got = tsv_fields(lines_df(frame, ["1\t2\t3\t4\t1\t2024", "1\t2\t3\t4\t5", "1\t2\t3\t4\t5\t6\t7"]), list("abcdef"))
    assert rows_of(got) == [("1", "2", "3", "4", "1", "2024")]


def test_read_lines(spark, tmp_path):
    path = tmp_path / "x.log"
    path.write_text("a\n\nb\n")
    assert read_lines(spark, str(path)).count() == 3
    assert read_lines(spark, str(path), 3).rdd.getNumPartitions() == 3


def test_every_spec_and_scan_is_well_formed():
    for name in FIELDS:
        cols = spec(name).columns
        assert len(cols) == len(set(cols))
    assert len(SCANS) == 34 - 2 + 2  # two shared by both cart tables
    for table, columns in SCANS.values():
        names = [n for _, n, _ in parse_columns(columns)]
        assert len(names) == len(set(names)) and table.startswith(("dwd.", "dws."))


def test_scans_read_columns_their_tables_have():
    from coursemill.operators import joins as J
    from coursemill.operators.member import DWS_MEMBER
    wide = {"dws.dws_member": DWS_MEMBER, "dws.dws_qz_chapter": J.QZ_CHAPTER, "dws.dws_qz_course": J.QZ_COURSE,
            "dws.dws_qz_major": J.QZ_MAJOR, "dws.dws_qz_paper": J.QZ_PAPER, "dws.dws_qz_question": J.QZ_QUESTION}
    for table, columns in SCANS.values():
        have = wide.get(table) or spec(table.partition(".")[2]).columns
        assert {s for s, _, _ in parse_columns(columns)} <= set(have), table


# --- scalars -----------------------------------------------------------------------

def test_dates(spark):
    assert one(spark, S.dt_to_date(F.lit("20240229"))) == "2024-02-29"
    assert one(spark, S.dt_to_date(F.lit("2024"))) is None
    assert one(spark, S.epoch_to_day(F.lit(1704067199999))) == "20231231"
    assert one(spark, S.now_string(at=F.timestamp_seconds(F.lit(0)))) == "1970-01-01 00:00:00"


@pytest.mark.parametrize("part,whole,want", [(1, 3, "33%"), (1, 8, "12%"), (3, 8, "38%"), (0, 5, "0%"), (5, 0, "0%"),
                                             (None, 4, "0%"), (7, 2, "350%")])
def test_percent_text(spark, part, whole, want):
    assert one(spark, S.percent_text(F.lit(part).cast("bigint"), F.lit(whole).cast("bigint"))) == want


@pytest.mark.parametrize("score,want", [("0", "0-20"), ("20", "0-20"), ("20.5", "20-40"), ("40", "20-40"), ("60", "40-60"),
                                        ("60.5", "60-80"), ("100", "80-100"), ("101", None), ("-1", None), (None, None)])
def test_score_band(spark, score, want):
    assert one(spark, S.score_band(F.lit(score).cast("decimal(4,1)"))) == want


@pytest.mark.parametrize("ip,want", [("0.0.0.0", 0), ("1.2.3.4", 16909060), ("255.255.255.255", 4294967295),
                                     ("1.2.3", None), ("1.2.3.256", None), ("a.b.c.d", None), ("", None)])
def test_ip_to_long(spark, ip, want):
    assert one(spark, S.ip_to_long(F.lit(ip))) == want


def test_region_field(spark):
    assert one(spark, S.region_field(F.lit("c|0|p|t|i"), 2)) == "p"
    assert one(spark, S.region_field(F.lit("c|0"), 2)) is None


def test_strip_digits_dots(spark):
    assert one(spark, S.strip_digits_dots(F.lit("1234aaa.qweqweqwe."))) == "aaaqweqweqwe"
    assert one(spark, S.strip_digits_dots(F.lit("a1.2b"))) == "a12b"


def test_interval_text_round_trip(spark):
    parsed = S.parse_intervals(F.lit("30-40,5-9"))
    assert one(spark, S.interval_text(parsed)) == "5-9,30-40"
    assert one(spark, S.interval_text(S.parse_intervals(F.lit("")))) == ""


def test_id_sets(spark):
    both = S.id_set_union(S.text_to_ids(F.lit("1,2,2")), S.text_to_ids(F.lit("3,1")))
    assert one(spark, S.ids_to_text(both)) == "1,2,3"
    assert one(spark, S.ids_to_text(S.id_set_union(S.text_to_ids(F.lit("1")), F.lit(None).cast("array<string>")))) == "1"


def test_seconds_between_cuts_fractions(spark):
    assert one(spark, S.seconds_between(F.lit(1000), F.lit(3999))) == 2
