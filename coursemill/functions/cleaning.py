"""Field cleaning used while raw logs become typed tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables of the log formats.
REGISTER_SOURCES = {"1": "PC", "2": "Mobile", "3": "App", "4": "WeChat"}
REGISTER_SOURCE_DEFAULT = "other"
APP_NAMES = {"1": "PC", "2": "APP"}
APP_NAME_DEFAULT = "Other"
APP_IDS = {"PC": 1, "APP": 2, "Other": 3}
PASSWORD_MASK = "******"


def int_or_zero(c: Column) -> Column:
    """Text to a whole number of 64 bits; missing, null or non-numeric text is 0, fractions are cut."""
    whole = c.try_cast("bigint")
    cut = c.try_cast("decimal(38,10)").try_cast("bigint")
    return F.coalesce(whole, cut, F.lit(0).cast("bigint"))


def is_bad_int(c: Column) -> Column:
    """True where ``int_or_zero`` had to give up on text that was present."""
    return c.isNotNull() & (F.trim(c) != "") & c.try_cast("decimal(38,10)").try_cast("bigint").isNull()


def long_or_null(c: Column) -> Column:
    return c.try_cast("bigint")


def string_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def decimal_half_up(c: Column, scale: int = 1, precision: int = 20) -> Column:
    """Round half up to ``scale`` places; text that is no number becomes null."""
    return c.try_cast(f"decimal({precision},{scale})")


def mask_name(c: Column) -> Column:
    """First character followed by ``xx``; nothing to mask gives null."""
    return F.when(F.length(c) > 0, F.concat(F.substring(c, 1, 1), F.lit("xx")))


def mask_phone(c: Column) -> Column:
    """Characters 1-3 and 8-11 around five stars; too short gives null."""
    return F.when(
        F.length(c) >= 11,
        F.concat(F.substring(c, 1, 3), F.lit("*****"), F.substring(c, 8, 4)),
    )


def mask_const(mask: str = PASSWORD_MASK) -> Column:
    return F.lit(mask)


def code_map(c: Column, mapping: dict, default) -> Column:
    """Look a code up; null and unknown codes take the default."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def register_source_name(c: Column) -> Column:
    return code_map(c, REGISTER_SOURCES, REGISTER_SOURCE_DEFAULT)


def app_name(c: Column) -> Column:
    return code_map(c, APP_NAMES, APP_NAME_DEFAULT)
