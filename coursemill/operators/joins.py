"""Joins: skew-aware building blocks and the wide joins of the warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import ip_to_long

SALT = "_salt"
BROADCAST_LIMIT = 64 * 1024 * 1024  # bytes the optimizer may estimate for a hinted side
SALT_COPIES = 100  # fixed value: copies of the small side
HOT_ROWS = 1_000_000  # rows above which one key is spread over several tasks


def rename_drop(df: DataFrame, renames: dict[str, str] | None = None, drops: list[str] | None = None) -> DataFrame:
    """Rename and drop clashing columns before a join; absent columns are ignored."""
    return df.drop(*(drops or [])).withColumnsRenamed(renames or {})


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's own estimate of a frame's size; huge where it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


TIMES = "_times"
AT_ONCE = 4096  # copies of a row that one step of unfolding makes


def fold_equal(df: DataFrame) -> DataFrame:
    """Different rows with the number of times they occur (``_times``), combined inside each task before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(TIMES))


def spread_folded(folded: DataFrame, n: int) -> DataFrame:
    """Deal folded rows over ``n`` salts: different rows by hash, equal rows in up to ``n`` equal shares of their number.

    A salt depends on a row and its number alone, so a retried task puts every share where the first attempt put it.
    """
    rows = [c for c in folded.columns if c != TIMES]
    shares = folded.withColumn("_share", F.explode(F.sequence(F.lit(0), (F.least(F.col(TIMES), F.lit(n)) - 1).cast("int"))))
    first = F.xxhash64(*[F.col(c) for c in rows])
    times = F.floor(F.col(TIMES) / n) + F.when(F.col("_share") < F.col(TIMES) % n, 1).otherwise(0)
    return (shares.withColumn(SALT, F.pmod(first + F.col("_share"), F.lit(n)).cast("int"))
            .withColumn(TIMES, F.when(F.col(TIMES) <= n, F.lit(1)).otherwise(times).cast("bigint")).drop("_share"))


def unfold(df: DataFrame) -> DataFrame:
    """Each row as often as ``_times`` says (once, where it is null), in steps of bounded size."""
    times = F.coalesce(F.col(TIMES), F.lit(1).cast("bigint"))
    steps = df.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / AT_ONCE))))
    left = F.least(times - F.col("_step") * AT_ONCE, F.lit(AT_ONCE))
    return steps.withColumn("_copy", F.explode(F.sequence(F.lit(1), left.cast("int")))).drop(TIMES, "_step", "_copy")


def salted_join(small: DataFrame, big: DataFrame, keys: list[str], how: str = "right",
                n: int = SALT_COPIES) -> DataFrame:
    """``small`` joined to ``big`` with every key of ``big`` spread over ``n`` tasks.

    Rows of ``big`` take a salt, rows of ``small`` are copied once per salt. Equal rows of ``big`` are one row with a
    number while they are shuffled and joined; the number is dealt over the salts as well.
    The copies are never broadcast: the optimizer takes them for as small as ``small`` itself.
    ``how`` is ``right`` (keep all of ``big``) or ``inner``: with any other kind
    the copies that find no partner would surface as extra rows.
    """
    if how not in ("right", "inner"):
        raise ValueError("a salted join keeps the salted side: use right or inner")
    copies = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return unfold(copies.hint("merge").join(spread_folded(fold_equal(big), n), [*keys, SALT], how).drop(SALT))


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys held by more than ``min_rows`` rows; counts are combined before the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > min_rows).select(*keys))


def hot_left_join(left: DataFrame, right: DataFrame, keys: list[str], n: int = SALT_COPIES,
                  min_rows: int = HOT_ROWS) -> DataFrame:
    """Left join that stays balanced when one key owns much of ``right``.

    Spark splits a skewed partition of the outer (left) side at run time but
    never one of the right side, so hot right keys are salted here, their equal
    rows folded as in ``salted_join``. Left rows of a hot key are copied per
    salt; a hot key exists on the right by definition, so a copy without a
    partner is only a leftover and is removed.
    """
    # At most one key in ``min_rows`` rows is hot, so the keys fit into every task.
    hot = F.broadcast(hot_keys(right, keys, min_rows).withColumn("_hot", F.lit(True)))
    marked = right.join(hot, keys, "left")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").withColumns({TIMES: F.lit(1).cast("bigint"), SALT: F.lit(0)})
    salted = spread_folded(fold_equal(marked.where("_hot").drop("_hot")), n)
    spread = rest.unionByName(salted).withColumn("_hit", F.lit(True))
    copies = (left.join(hot, keys, "left")
              .withColumn(SALT, F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1)))
                                          .otherwise(F.array(F.lit(0))))))
    joined = copies.join(spread, [*keys, SALT], "left")
    return unfold(joined.where(F.col("_hot").isNull() | F.col("_hit").isNotNull())).drop(SALT, "_hot", "_hit")


def fit_to_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` for every executor if the optimizer's estimate of its size allows it, else as it is."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def broadcast_join(small: DataFrame, big: DataFrame, keys: list[str], how: str = "right",
                   limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Join that ships ``small`` to every executor while its size allows it.

    Past ``limit`` the salted join takes over, which gives the same rows.
    """
    if estimated_bytes(small) <= limit:
        return F.broadcast(small).join(big, keys, how)
    return salted_join(small, big, keys, how)


# --- course sales ------------------------------------------------------------

# fixed values: columns of the sales detail table
SALES_DETAIL = ("courseid coursename status pointlistid majorid chapterid chaptername edusubjectid edusubjectname "
                "teacherid teachername coursemanager money orderid cart_discount sellmoney cart_createtime "
                "pay_discount paymoney pay_createtime dt dn").split()
SALE_KEYS = ["courseid", "dt", "dn"]
ORDER_KEYS = ["orderid", "dt", "dn"]


def _sales_inputs(cart: DataFrame, pay: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (rename_drop(cart, {"discount": "cart_discount", "createtime": "cart_createtime"}, ["coursename"]),
            rename_drop(pay, {"discount": "pay_discount", "createtime": "pay_createtime"}))


def _present(df: DataFrame, columns: list[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def cart_join(sale: DataFrame, cart: DataFrame, pay: DataFrame) -> DataFrame:
    """Every cart row with its course and its payment, physical plan left to Spark."""
    cart, pay = _sales_inputs(cart, pay)
    return _present(sale.join(cart, SALE_KEYS, "right").join(pay, ORDER_KEYS, "left"), SALES_DETAIL)


def cart_join_salted(sale: DataFrame, cart: DataFrame, pay: DataFrame, n: int = SALT_COPIES) -> DataFrame:
    """The cart join with hot courses spread over ``n`` tasks."""
    cart, pay = _sales_inputs(cart, pay)
    wide = salted_join(sale, cart, SALE_KEYS, "right", n)
    return _present(wide.join(pay, ORDER_KEYS, "left"), SALES_DETAIL)


def cart_join_broadcast(sale: DataFrame, cart: DataFrame, pay: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The cart join without a shuffle of the carts for the course side."""
    cart, pay = _sales_inputs(cart, pay)
    wide = broadcast_join(sale, cart, SALE_KEYS, "right", limit)
    return _present(wide.join(pay, ORDER_KEYS, "left"), SALES_DETAIL)


def cart_join_bucketed(sale: DataFrame, cart: DataFrame, pay: DataFrame, hot_cart: DataFrame | None = None,
                       limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The cart join over tables bucketed by order: carts and payments meet without a shuffle.

    Buckets follow ``orderid`` alone. ``dt`` and ``dn`` are compared as ranges,
    which Spark keeps beside the join key; as further equalities they would
    become join keys that the buckets do not cover and force a shuffle.
    ``hot_cart`` holds the carts of orders too large for a bucket; those meet
    their payment, one row per order, in a join Spark can split.
    """
    if hot_cart is not None:
        few = pay.join(hot_cart.select(*ORDER_KEYS).distinct(), ORDER_KEYS, "left_semi").select(*pay.columns)
        return cart_join_bucketed(sale, cart, pay, limit=limit).unionByName(
            cart_join_broadcast(sale, hot_cart, few, limit))
    cart, pay = _sales_inputs(cart, pay)
    pay = pay.withColumnsRenamed({c: f"_p_{c}" for c in ORDER_KEYS})
    same = (F.col("orderid") == F.col("_p_orderid"))
    for c in ("dt", "dn"):
        same = same & (F.col(c) >= F.col(f"_p_{c}")) & (F.col(c) <= F.col(f"_p_{c}"))
    paid = cart.join(pay, same, "left").drop(*[f"_p_{c}" for c in ORDER_KEYS])
    return _present(broadcast_join(sale, paid, SALE_KEYS, "right", limit), SALES_DETAIL)


# --- question bank -----------------------------------------------------------

# fixed values: output columns of the question-bank wide tables
QZ_CHAPTER = ("chapterid chapterlistid chaptername sequence showstatus status chapter_creator chapter_createtime "
              "chapter_courseid chapternum chapterallnum outchapterid chapterlistname pointid questionid questype "
              "pointname pointyear chapter excisenum pointlistid pointdescribe pointlevel typelist point_score "
              "thought remid pointnamelist typelistids pointlist dt dn").split()
QZ_COURSE = ("sitecourseid siteid courseid sitecoursename coursechapter sequence status sitecourse_creator "
             "sitecourse_createtime helppaperstatus servertype boardid showstatus majorid coursename isadvc "
             "chapterlistid pointlistid courseeduid edusubjectid dt dn").split()
QZ_MAJOR = ("majorid businessid siteid majorname shortname status sequence major_creator major_createtime "
            "businessname sitename domain multicastserver templateserver multicastgateway multicastport dt dn").split()
QZ_PAPER = ("paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime "
            "conteststarttime contestendtime contesttimelimit dayiid status paper_view_creator "
            "paper_view_createtime paperviewcatid modifystatus description paperuse paperdifficult testreport "
            "paperuseshow centerid sequence centername centeryear centertype provideuser centerviewtype stage "
            "papercatid courseid paperyear suitnum papername totalscore chapterid chapterlistid dt dn").split()
QZ_QUESTION = ("questionid parentid questypeid quesviewtype content answer analysis limitminute score splitscore "
               "status optnum lecture creator createtime modifystatus attanswer questag vanalysisaddr difficulty "
               "quesskill vdeoaddr viewtypename papertypename description remark splitscoretype dt dn").split()
ANSWER_DETAIL = ("userid courseid questionid useranswer istrue lasttime opertype paperid spendtime chapterid "
                 "chaptername chapternum chapterallnum outchapterid chapterlistname pointid questype pointyear "
                 "chapter pointname excisenum pointdescribe pointlevel typelist point_score thought remid "
                 "pointnamelist typelistids pointlist sitecourseid siteid sitecoursename coursechapter "
                 "course_sequence course_status course_creator course_createtime servertype helppaperstatus "
                 "boardid showstatus majorid coursename isadvc chapterlistid pointlistid courseeduid edusubjectid "
                 "businessid majorname shortname major_status major_sequence major_creator major_createtime "
                 "businessname sitename domain multicastserver templateserver multicastgateway multicastport "
                 "paperviewid paperviewname paperparam openstatus explainurl iscontest contesttime "
                 "conteststarttime contestendtime contesttimelimit dayiid paper_status paper_view_creator "
                 "paper_view_createtime paperviewcatid modifystatus description paperuse testreport centerid "
                 "paper_sequence centername centeryear centertype provideuser centerviewtype paper_stage "
                 "papercatid paperyear suitnum papername totalscore question_parentid questypeid quesviewtype "
                 "question_content question_answer question_analysis question_limitminute score splitscore "
                 "lecture question_creator question_createtime question_modifystatus question_attanswer "
                 "question_questag question_vanalysisaddr question_difficulty quesskill vdeoaddr "
                 "question_description question_splitscoretype user_question_answer dt dn").split()


def join_chain(first: DataFrame, *steps: tuple[DataFrame, list[str], str]) -> DataFrame:
    """Equi joins one after the other; Spark picks each strategy from the sizes it sees."""
    return reduce(lambda df, step: df.join(*step), steps, first)


def chapter_join(chapter: DataFrame, chapter_list: DataFrame, point: DataFrame,
                 point_question: DataFrame) -> DataFrame:
    """Chapters with their list, points and questions: one row per question."""
    return _present(join_chain(chapter,
                               (chapter_list, ["chapterlistid", "dn"], "inner"),
                               (point, ["chapterid", "dn"], "inner"),
                               (point_question, ["pointid", "dn"], "inner")), QZ_CHAPTER)


def course_join(site_course: DataFrame, course: DataFrame, edusubject: DataFrame) -> DataFrame:
    """Site courses with their course and education subject."""
    return _present(join_chain(site_course,
                               (course, ["courseid", "dn"], "inner"),
                               (edusubject, ["courseid", "dn"], "inner")), QZ_COURSE)


def major_join(major: DataFrame, website: DataFrame, business: DataFrame) -> DataFrame:
    """Majors with their site and line of business."""
    return _present(join_chain(major,
                               (website, ["siteid", "dn"], "inner"),
                               (business, ["businessid", "dn"], "inner")), QZ_MAJOR)


def paper_join(paper_view: DataFrame, center_paper: DataFrame, center: DataFrame, paper: DataFrame) -> DataFrame:
    """Paper views, with or without an exam centre, and their paper."""
    return _present(join_chain(paper_view,
                               (center_paper, ["paperviewid", "dn"], "left"),
                               (center, ["centerid", "dn"], "left"),
                               (paper, ["paperid", "dn"], "inner")), QZ_PAPER)


def question_join(question: DataFrame, question_type: DataFrame) -> DataFrame:
    """Questions with their type."""
    return _present(question.join(question_type, ["questypeid", "dn"], "inner"), QZ_QUESTION)


def answer_detail_join(answers: DataFrame, course: DataFrame, chapter: DataFrame, major: DataFrame,
                       paper: DataFrame, question: DataFrame, distinct_chapter: bool = False) -> DataFrame:
    """Answers with everything known about their course, chapter, major, paper and question.

    The chapter table holds one row per question of a chapter, so an answer
    comes out once per such row. ``distinct_chapter`` first folds the chapter
    table to one row per chapter.
    """
    answers = rename_drop(answers, {"question_answer": "user_question_answer"}, ["paperid"])
    course = rename_drop(course, {"sitecourse_creator": "course_creator",
                                  "sitecourse_createtime": "course_createtime"},
                         ["majorid", "chapterlistid", "pointlistid"])
    if distinct_chapter:
        rest = [c for c in chapter.columns if c not in ("chapterid", "dn")]
        chapter = (chapter.groupBy("chapterid", "dn").agg(F.min(F.struct(*rest)).alias("_c"))
                   .select("chapterid", "dn", "_c.*"))
    wide = join_chain(answers,
                      (course, ["sitecourseid", "dn"], "inner"),
                      (rename_drop(chapter, drops=["courseid"]), ["chapterid", "dn"], "inner"),
                      (major, ["majorid", "dn"], "inner"),
                      (rename_drop(paper, drops=["courseid"]), ["paperviewid", "dn"], "inner"),
                      (question, ["questionid", "dn"], "inner"))
    return _present(wide, ANSWER_DETAIL)


# --- state and ranges ----------------------------------------------------------

def state_full_outer_merge(history: DataFrame, batch: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Stored totals plus the totals of a batch; a missing side counts as zero.

    Both sides hold one row per key, so the join cannot be skewed.
    """
    h, b = history.alias("h"), batch.alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"h.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return h.join(b, on, "full").select(
        *[F.coalesce(F.col(f"h.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
        *[(F.coalesce(F.col(f"h.{v}"), F.lit(0)) + F.coalesce(F.col(f"b.{v}"), F.lit(0))).alias(v) for v in values])


def ip_region_join(rows: DataFrame, ranges: DataFrame, ip: str = "ip", block_bits: int = 16) -> DataFrame:
    """Attach the ``region`` whose ``lo``..``hi`` range holds the address, or null.

    A bare range condition would compare every row with every range. Addresses
    and ranges are cut into blocks of ``2**block_bits`` first, which leaves an
    equality join on the block and a check inside it. Ranges must not overlap.
    """
    def block(c: F.Column) -> F.Column:
        return F.shiftright(c, block_bits)
    blocks = ranges.select("lo", "hi", "region",
                           F.explode(F.sequence(block(F.col("lo")), block(F.col("hi")))).alias("_block"))
    found = rows.withColumn("_ip", ip_to_long(F.col(ip))).withColumn("_rows_block", block(F.col("_ip")))
    on = (F.col("_rows_block") == F.col("_block")) & F.col("_ip").between(F.col("lo"), F.col("hi"))
    return found.join(blocks, on, "left").drop("_ip", "_rows_block", "_block", "lo", "hi")
