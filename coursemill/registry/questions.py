"""Question bank: wide tables, paper and question reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.operators import joins as J
from coursemill.operators import metrics as M
from coursemill.registry import inputs as I
from coursemill.registry.inputs import DN, DT, plain, table, text


def _dims(df: DataFrame, **cols) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in cols.items()], F.lit(DN).alias("dn"))


def join_inner_chain4(spark: SparkSession, sf: str) -> DataFrame:
    """Chapter = nation, list = region, point = customer, point question = order."""
    c = F.col
    chapter = _dims(table(spark, sf, "nation"), chapterid=c("n_nationkey"), chapterlistid=c("n_regionkey"),
                    chaptername=c("n_name"), dt=F.lit(DT))
    listing = _dims(table(spark, sf, "region"), chapterlistid=c("r_regionkey"), chapterlistname=c("r_name"))
    point = _dims(table(spark, sf, "customer"), pointid=c("c_custkey"), chapterid=c("c_nationkey"),
                  pointname=c("c_name"), point_score=c("c_acctbal"))
    question = _dims(table(spark, sf, "orders"), pointid=c("o_custkey"), questionid=c("o_orderkey"),
                     questype=c("o_orderpriority"))
    return J.chapter_join(chapter, listing, point, question)


def join_inner_chain3(spark: SparkSession, sf: str) -> DataFrame:
    """Site course = lineitem, course = part, education subject = supplier."""
    c = F.col
    site_course = _dims(table(spark, sf, "lineitem"), sitecourseid=c("l_orderkey"), courseid=c("l_partkey"),
                        sequence=c("l_linenumber"), dt=F.lit(DT))
    course = _dims(table(spark, sf, "part"), courseid=c("p_partkey"), coursename=c("p_name"), isadvc=c("p_brand"))
    subject = _dims(table(spark, sf, "supplier"), courseid=c("s_suppkey"), courseeduid=c("s_nationkey"),
                    edusubjectid=c("s_suppkey"))
    return J.course_join(site_course, course, subject)


def join_major_star(spark: SparkSession, sf: str) -> DataFrame:
    """Major = supplier, site = region, business = nation."""
    c = F.col
    major = _dims(table(spark, sf, "supplier"), majorid=c("s_suppkey"), businessid=c("s_nationkey"),
                  siteid=c("s_nationkey") % 5, majorname=c("s_name"), dt=F.lit(DT))
    website = _dims(table(spark, sf, "region"), siteid=c("r_regionkey"), sitename=c("r_name"))
    business = _dims(table(spark, sf, "nation"), businessid=c("n_nationkey"), businessname=c("n_name"))
    return J.major_join(major, website, business)


def join_mixed_left_inner(spark: SparkSession, sf: str) -> DataFrame:
    """Paper view = customer, centre paper = finished order, centre = its lineitems, paper = nation."""
    c = F.col
    view = _dims(table(spark, sf, "customer"), paperviewid=c("c_custkey"), paperid=c("c_nationkey"),
                 paperviewname=c("c_name"), dt=F.lit(DT))
    center_paper = _dims(table(spark, sf, "orders").where("o_orderstatus = 'F'"), paperviewid=c("o_custkey"),
                         centerid=text("o_orderkey"), sequence=c("o_orderpriority"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    center = _dims(lines, centerid=text("l_orderkey"), centername=F.concat(F.lit("lines-"), text("n")))
    paper = _dims(table(spark, sf, "nation"), paperid=c("n_nationkey"), papername=c("n_name"))
    return J.paper_join(view, center_paper, center, paper)


def join_question_type(spark: SparkSession, sf: str) -> DataFrame:
    """Question = part, type = brand."""
    c = F.col
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    parts = table(spark, sf, "part")
    question = _dims(parts, questionid=c("p_partkey"), questypeid=brand, content=c("p_name"), optnum=c("p_size"),
                     dt=F.lit(DT))
    kinds = parts.groupBy("p_brand").agg(F.max("p_size").alias("top"))
    kind = _dims(kinds, questypeid=brand, viewtypename=c("p_brand"), remark=text("top"))
    return J.question_join(question, kind)


def join_answer_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Answer = lineitem, course = order, chapter = region, major = nation, paper = supplier, question = part."""
    c = F.col
    answer = _dims(table(spark, sf, "lineitem"), userid=c("l_orderkey"), paperviewid=c("l_suppkey"),
                   chapterid=(c("l_linenumber") % 5), sitecourseid=c("l_orderkey"), questionid=c("l_partkey"),
                   majorid=c("l_suppkey") % 25, useranswer=c("l_returnflag"), istrue=c("l_linestatus"),
                   paperid=c("l_suppkey"), spendtime=c("l_quantity"), question_answer=c("l_linenumber"),
                   score=c("l_discount"), dt=I.month_of("l_shipdate"))
    course = _dims(table(spark, sf, "orders"), sitecourseid=c("o_orderkey"), courseid=c("o_custkey"),
                   sitecoursename=c("o_orderpriority"), sitecourse_creator=c("o_orderstatus"), majorid=c("o_custkey"))
    chapter = _dims(table(spark, sf, "region"), chapterid=c("r_regionkey"), chaptername=c("r_name"))
    major = _dims(table(spark, sf, "nation"), majorid=c("n_nationkey"), majorname=c("n_name"))
    paper = _dims(table(spark, sf, "supplier"), paperviewid=c("s_suppkey"), paperviewname=c("s_name"),
                  paperid=c("s_nationkey"), courseid=c("s_suppkey"))
    question = _dims(table(spark, sf, "part"), questionid=c("p_partkey"), question_content=c("p_name"),
                     question_questag=c("p_brand"))
    return J.answer_detail_join(answer, course, chapter, major, paper, question)


def paper_avg(spark: SparkSession, sf: str) -> DataFrame:
    return plain(M.paper_avg(I.detail(spark, sf)))


def paper_max_min(spark: SparkSession, sf: str) -> DataFrame:
    return plain(M.paper_max_min(I.detail(spark, sf)))


def paper_top3(spark: SparkSession, sf: str) -> DataFrame:
    return plain(M.paper_top3(I.detail(spark, sf)))


def paper_low3(spark: SparkSession, sf: str) -> DataFrame:
    return plain(M.paper_low3(I.detail(spark, sf)))


def score_segment_users(spark: SparkSession, sf: str) -> DataFrame:
    return M.score_segment_users(I.detail(spark, sf))


def paper_pass_rate(spark: SparkSession, sf: str) -> DataFrame:
    return plain(M.paper_pass_rate(I.detail(spark, sf)))


def question_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    return plain(M.question_error_rate(I.detail(spark, sf)))


def paper_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Average, extremes and pass rate of each paper side by side, from one pass over the answers."""
    one = M.paper_summary(I.detail(spark, sf))
    return plain(one.select(*M.PAPER, F.col("_avgscore").alias("avgscore"), F.col("_max").alias("maxscore"), F.col("_min").alias("minscore"),
                            "unpasscount", F.col("_pass").alias("passcount")))


def rate_pair_join(spark: SparkSession, sf: str) -> DataFrame:
    """Wrong and right answers of each question, counted apart and put side by side."""
    rows, keys = I.detail(spark, sf), ["questionid", "dt", "dn"]
    counts = [rows.where(F.col("user_question_answer") == v).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
              for v, name in ((0, "errcount"), (1, "rightcount"))]
    return plain(M.rate_pair_join(counts[0], counts[1], keys, "errcount", "rightcount"))


def salted_count(spark: SparkSession, sf: str) -> DataFrame:
    return M.salted_count(I.events(spark, sf), "event_type")


QUERIES = {f.__name__: f for f in (
    join_inner_chain4, join_inner_chain3, join_major_star, join_mixed_left_inner, join_question_type,
    join_answer_detail, paper_avg, paper_max_min, paper_top3, paper_low3, score_segment_users, paper_pass_rate,
    question_error_rate, paper_summary, rate_pair_join, salted_count)}


def _detail(sql: str) -> str:
    return I.with_ctes(["detail"], sql)


def _half_up(total: str, n: str, places: int) -> str:
    """Exact half-up rounding of total / n, both whole numbers."""
    p = 10 ** places
    return f"((2 * {p} * ({total}) + ({n})) // (2 * ({n})))"


def _rank_sql(direction: str) -> str:
    return _detail(f"""
        SELECT userid, paperviewid, paperviewname, chaptername, pointname, CAST(score AS DOUBLE) AS score, rk, dt, dn
        FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY dt, paperviewid ORDER BY score {direction}) AS INTEGER) AS rk
              FROM detail) WHERE rk <= 3""")


_BAND = """CASE WHEN score BETWEEN 0 AND 20 THEN '0-20' WHEN score > 20 AND score <= 40 THEN '20-40'
                WHEN score > 40 AND score <= 60 THEN '40-60' WHEN score > 60 AND score <= 80 THEN '60-80'
                WHEN score > 80 AND score <= 100 THEN '80-100' END"""

SQL = {
    "join_inner_chain4": """
        SELECT n_nationkey AS chapterid, r_regionkey AS chapterlistid, n_name AS chaptername, r_name AS chapterlistname,
               c_custkey AS pointid, o_orderkey AS questionid, o_orderpriority AS questype, c_name AS pointname,
               c_acctbal AS point_score, '20240101' AS dt, 'web' AS dn
        FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
             JOIN orders ON o_custkey = c_custkey""",
    "join_inner_chain3": """
        SELECT l_orderkey AS sitecourseid, l_partkey AS courseid, l_linenumber AS sequence, p_name AS coursename,
               p_brand AS isadvc, s_nationkey AS courseeduid, s_suppkey AS edusubjectid, '20240101' AS dt, 'web' AS dn
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_partkey""",
    "join_major_star": """
        SELECT s_suppkey AS majorid, n_nationkey AS businessid, r_regionkey AS siteid, s_name AS majorname,
               n_name AS businessname, r_name AS sitename, '20240101' AS dt, 'web' AS dn
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = s_nationkey % 5""",
    "join_mixed_left_inner": """
        SELECT c_custkey AS paperviewid, c_nationkey AS paperid, c_name AS paperviewname, CAST(o_orderkey AS VARCHAR) AS centerid,
               o_orderpriority AS sequence, 'lines-' || n AS centername, n_name AS papername, '20240101' AS dt, 'web' AS dn
        FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey
             LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
             JOIN nation ON n_nationkey = c_nationkey""",
    "join_question_type": """
        WITH kinds AS (SELECT p_brand AS brand, max(p_size) AS top FROM part GROUP BY p_brand)
        SELECT p_partkey AS questionid, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS questypeid,
               p_name AS content, p_size AS optnum, brand AS viewtypename, CAST(top AS VARCHAR) AS remark,
               '20240101' AS dt, 'web' AS dn FROM part JOIN kinds ON brand = p_brand""",
    "join_answer_detail": """
        SELECT l_orderkey AS userid, o_custkey AS courseid, l_partkey AS questionid, l_returnflag AS useranswer,
               l_linestatus AS istrue, s_nationkey AS paperid, l_quantity AS spendtime, l_linenumber % 5 AS chapterid,
               r_name AS chaptername, l_orderkey AS sitecourseid, o_orderpriority AS sitecoursename,
               o_orderstatus AS course_creator, l_suppkey % 25 AS majorid, n_name AS majorname,
               l_suppkey AS paperviewid, s_name AS paperviewname, p_name AS question_content, l_discount AS score,
               p_brand AS question_questag, l_linenumber AS user_question_answer, strftime(l_shipdate, '%Y%m') AS dt,
               'web' AS dn
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN region ON r_regionkey = l_linenumber % 5
             JOIN nation ON n_nationkey = l_suppkey % 25 JOIN supplier ON s_suppkey = l_suppkey
             JOIN part ON p_partkey = l_partkey""",
    # The score is a decimal: Spark rounds its average to five places, the report to one.
    "paper_avg": _detail(f"""
        SELECT paperviewid, paperviewname,
               CAST(({_half_up('sum(score)', 'count(score)', 5)} + 5000) // 10000 AS DOUBLE) / 10 AS avgscore,
               CAST({_half_up('sum(spendtime)', 'count(spendtime)', 1)} AS DOUBLE) / 10 AS avgspendtime, dt, dn
        FROM detail GROUP BY paperviewid, paperviewname, dt, dn"""),
    "paper_max_min": _detail("""
        SELECT paperviewid, paperviewname, CAST(max(score) AS DOUBLE) AS maxscore, CAST(min(score) AS DOUBLE) AS minscore,
               dt, dn FROM detail GROUP BY paperviewid, paperviewname, dt, dn"""),
    "paper_top3": _rank_sql("DESC"),
    "paper_low3": _rank_sql("ASC"),
    "score_segment_users": _detail(f"""
        SELECT paperviewid, paperviewname, score_segment, part,
               string_agg(CAST(userid AS VARCHAR), ',' ORDER BY userid) AS userids, dt, dn
        FROM (SELECT *, (row_number() OVER (PARTITION BY paperviewid, paperviewname, score_segment, dt, dn
                                            ORDER BY userid) - 1) // 100000 AS part
              FROM (SELECT *, {_BAND} AS score_segment FROM detail))
        GROUP BY paperviewid, paperviewname, score_segment, part, dt, dn"""),
    "paper_pass_rate": _detail(f"""
        SELECT paperviewid, paperviewname, unpasscount, passcount,
               CAST({_half_up('passcount', 'passcount + unpasscount', 2)} AS DOUBLE) / 100 AS rate, dt, dn
        FROM (SELECT paperviewid, paperviewname, dt, dn, count(*) AS unpasscount FROM detail
              WHERE score BETWEEN 0 AND 60 GROUP BY paperviewid, paperviewname, dt, dn)
        JOIN (SELECT paperviewid, dt, dn, count(*) AS passcount FROM detail WHERE score > 60
              GROUP BY paperviewid, dt, dn) USING (paperviewid, dt, dn)"""),
    "question_error_rate": _detail(f"""
        SELECT questionid, errcount, rightcount,
               CAST({_half_up('errcount', 'errcount + rightcount', 2)} AS DOUBLE) / 100 AS rate, dt, dn
        FROM (SELECT questionid, dt, dn, count(*) AS errcount FROM detail WHERE answer = 0 GROUP BY questionid, dt, dn)
        JOIN (SELECT questionid, dt, dn, count(*) AS rightcount FROM detail WHERE answer = 1
              GROUP BY questionid, dt, dn) USING (questionid, dt, dn)"""),
    "paper_summary": _detail(f"""
        SELECT paperviewid, paperviewname, CAST({_half_up('sum(score)', 'count(score)', 5)} AS DOUBLE) / 100000 AS avgscore,
               CAST(max(score) AS DOUBLE) AS maxscore, CAST(min(score) AS DOUBLE) AS minscore,
               count(*) FILTER (score BETWEEN 0 AND 60) AS unpasscount, count(*) FILTER (score > 60) AS passcount, dt, dn
        FROM detail GROUP BY paperviewid, paperviewname, dt, dn"""),
    "salted_count": "SELECT event_type, count(*) AS num FROM events GROUP BY event_type",
}
SQL["rate_pair_join"] = SQL["question_error_rate"]
