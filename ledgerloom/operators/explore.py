"""Faceted exploration of a mart: filters, search, sort, pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day
from ..functions.text import haystack
from .ordered import range_sorted


def facet(df: DataFrame, facets: dict[str | tuple[str, ...], str | None]) -> DataFrame:
    """Keep rows equal to each facet that is set; a tuple of columns matches on any of them."""
    for columns, value in facets.items():
        if value is None or value == "":
            continue
        names = (columns,) if isinstance(columns, str) else columns
        hit = F.lit(False)
        for name in names:
            hit = hit | F.coalesce(F.col(name) == F.lit(value), F.lit(False))
        df = df.filter(hit)
    return df


def between_days(df: DataFrame, column: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Inclusive date range; a missing bound is open."""
    if first is not None:
        df = df.filter(F.col(column) >= day(first))
    if last is not None:
        df = df.filter(F.col(column) <= day(last))
    return df


def search(df: DataFrame, term: str | None, columns: list[str]) -> DataFrame:
    """Case-insensitive substring search over the joined text of several columns."""
    if not term:
        return df
    return df.filter(F.contains(haystack(*columns), F.lit(term.lower())))


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values of a facet, sorted."""
    return df.select(F.col(column).alias("value")).filter(F.col("value") != "").distinct().orderBy("value")


def sort_keys(order: list[str]) -> list[Column]:
    """Sort expressions of column names; a leading minus sorts downwards."""
    return [F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in order]


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """Rows of one page; a number outside 1 to the last page takes the nearest.

    ``order`` names any columns, a leading minus sorts downwards; together they must tell rows apart. Every page, however
    deep, is found the same way: the sort columns alone are sorted, the page's places are read off, and these (at most
    ``size`` rows) pick their rows from the frame.
    """
    names = [c.removeprefix("-") for c in order]
    keys, parts = range_sorted(df.select(*names), sort_keys(order))
    last = parts.agg(F.greatest(F.ceil(F.coalesce(F.sum("_rows"), F.lit(0)) / size), F.lit(1)).cast("bigint")).scalar()
    at = F.least(F.lit(max(1, number)).cast("bigint"), last)
    row = F.col("_before") + F.col("_local")
    # A part without rows of the page is left out before any of its rows is looked at.
    held = parts.withColumn("_first", (at - 1) * size).filter(
        (F.col("_before") < F.col("_first") + size) & (F.col("_before") + F.col("_rows") > F.col("_first")))
    chosen = keys.join(F.broadcast(held), "_part").filter((row > F.col("_first")) & (row <= F.col("_first") + size))
    chosen = chosen.select(*[F.col(c).alias(f"_page_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"_page_{c}")) for c in names]
    return df.join(F.broadcast(chosen), same).select(*df.columns).orderBy(*sort_keys(order))
