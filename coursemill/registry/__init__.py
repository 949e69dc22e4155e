"""Every operator as a named query over the generated test tables, with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

AREAS = ("cleaning", "member", "questions", "sales", "history", "playback", "pages", "tables", "streams")

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for area in AREAS:
        out.update(import_module(f"{__name__}.{area}").QUERIES)
    return out


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for area in AREAS:
        out.update(import_module(f"{__name__}.{area}").SQL)
    return out
