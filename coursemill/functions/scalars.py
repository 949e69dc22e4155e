"""Small scalar expressions shared by batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"  # fixed value: end date of a history row still in force


def dt_to_date(c: Column) -> Column:
    """``yyyyMMdd`` text to ``yyyy-MM-dd`` text."""
    return F.date_format(F.try_to_date(c, "yyyyMMdd"), "yyyy-MM-dd")


def epoch_to_day(c: Column) -> Column:
    """Epoch milliseconds to a ``yyyyMMdd`` path part (session time zone)."""
    return F.date_format(F.timestamp_millis(c), "yyyyMMdd")


def now_string(pattern: str = "yyyy-MM-dd HH:mm:ss", at: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if at is None else at, pattern)


def seconds_between(ts: Column, te: Column) -> Column:
    """Whole seconds from ``ts`` to ``te``, both epoch milliseconds."""
    return F.floor((te - ts) / F.lit(1000)).cast("bigint")


def safe_rate(part: Column, rest: Column) -> Column:
    """part / (part + rest) as decimal(4,2); null where both are zero."""
    whole = part + rest
    return F.when(whole != 0, part / whole).cast("decimal(4,2)")


def percent_text(part: Column, whole: Column) -> Column:
    """Whole percent, half to even, as text; ``0%`` where there is no base."""
    ratio = F.bround(part.cast("double") / whole.cast("double") * 100, 0).cast("bigint")
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit("0%")).otherwise(
        F.concat(F.coalesce(ratio, F.lit(0)).cast("string"), F.lit("%")))


# Score bands as (label, above, up to); the first includes 0.
SCORE_BANDS = [("0-20", 0, 20), ("20-40", 20, 40), ("40-60", 40, 60),
               ("60-80", 60, 80), ("80-100", 80, 100)]
PASS_MARK = 60


def score_band(score: Column) -> Column:
    """Label of the band a score falls in; null outside 0 to 100."""
    band = F.when(score < 0, F.lit(None).cast("string"))
    for label, _, top in SCORE_BANDS:
        band = band.when(score <= top, F.lit(label))
    return band


def ids_to_text(ids: Column) -> Column:
    return F.concat_ws(",", ids)


def text_to_ids(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.split(text, ",")).otherwise(F.array().cast("array<string>"))


def id_set_union(a: Column, b: Column) -> Column:
    """Distinct union of two id arrays; a null side counts as empty."""
    none = F.array().cast("array<string>")
    return F.array_union(F.coalesce(a, none), F.coalesce(b, none))


def region_field(region: Column, n: int) -> Column:
    """The n-th (from 0) field of ``country|0|province|city|isp`` text."""
    return F.get(F.split(region, r"\|"), F.lit(n))


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text to its number; null unless it is four numbers up to 255."""
    parts = F.split(ip, r"\.")
    nums = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    good = F.size(parts) == 4
    total = F.lit(0).cast("bigint")
    for num in nums:
        good = good & num.between(0, 255)
        total = total * 256 + num
    return F.when(good, total)


def strip_digits_dots(c: Column) -> Column:
    """Drop the leading digits and every dot."""
    return F.regexp_replace(F.regexp_replace(c, r"^\d+", ""), r"\.", "")


def partition_path(*cols: str) -> Column:
    return F.concat_ws("/", *[F.col(c) for c in cols])


def interval_text(ranges: Column) -> Column:
    """Array of (s, e) structs to ``s-e,s-e`` text, in ascending order."""
    return F.array_join(
        F.transform(F.array_sort(ranges),
                    lambda r: F.concat(r["s"].cast("string"), F.lit("-"), r["e"].cast("string"))), ",")


def parse_intervals(text: Column) -> Column:
    """``s-e,s-e`` text back to an array of (s, e) structs."""
    def one(part: Column) -> Column:
        ends = F.split(part, "-")
        return F.struct(F.get(ends, F.lit(0)).try_cast("int").alias("s"),
                        F.get(ends, F.lit(1)).try_cast("int").alias("e"))
    return F.transform(text_to_ids(text), one)
