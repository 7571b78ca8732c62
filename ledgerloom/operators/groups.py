"""Grouped results: lists per key, total rows, spread columns, labelled groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import reference_data as ref
from .ordered import range_sorted, top_n_per_key

# Distinct values that a part of a list holds. It sets where lists are divided and leaves nothing out.
PART_SIZE = 1_000


def _values(links: DataFrame, keys: list[str], value: str) -> DataFrame:
    return links.select(*keys, value).filter(F.col(value).isNotNull()).distinct()


def list_parts(links: DataFrame, keys: list[str], value: str, part_size: int = PART_SIZE) -> DataFrame:
    """Distinct values per key as rows (keys, part_no, n_parts, n_values, values), in sort order.

    Part 0 has the first ``part_size`` values of a key, part 1 the next ones, and so on: all parts together are the whole
    list in order, however long, and no task holds more than a part. Duplicates are dropped before the values of a key meet.
    """
    rows, before = range_sorted(_values(links, keys, value), [F.col(c) for c in (*keys, value)])
    placed = rows.join(F.broadcast(before), "_part").withColumn("_at", F.col("_before") + F.col("_local"))
    spans = placed.groupBy(*keys).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n_values"))
    number = F.floor((F.col("_at") - F.col("_first")) / part_size).cast("bigint")
    parts = placed.join(spans, keys).select(
        *keys, number.alias("part_no"), F.ceil(F.col("n_values") / part_size).cast("bigint").alias("n_parts"), "n_values", value)
    return parts.groupBy(*keys, "part_no", "n_parts", "n_values").agg(F.array_sort(F.collect_list(value)).alias("values"))


def list_cell(links: DataFrame, keys: list[str], value: str, name: str, size: str, *, separator: str | None = ", ",
              part_size: int = PART_SIZE) -> DataFrame:
    """The list of each key as one joined text (or an array when ``separator`` is None), and the number of its values.

    A cell holds up to ``part_size`` values, the first in sort order. Where ``size`` is larger a joined text ends with the
    number of those left out, and ``list_parts`` of the same links has every value. A task sends no more than that of a key.
    """
    distinct = _values(links, keys, value).dropna(subset=keys)
    # A list that is whole tells its own number. Only longer ones are counted, at most one for each ``part_size`` links.
    longer = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)).filter(F.col(size) > part_size)
    first = top_n_per_key(distinct, keys, [F.col(value)], part_size, "_n")
    cells = first.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("_values")).join(F.broadcast(longer), keys, "left")
    held = F.size("_values").cast("bigint")
    cells = cells.withColumn(size, F.coalesce(size, held))
    left = F.col(size) - held
    text = F.array_join("_values", separator) if separator is not None else None
    cell = F.col("_values") if text is None else F.when(left > 0, F.concat(text, F.lit(f"{separator}… +"), left)).otherwise(text)
    return cells.select(*keys, cell.alias(name), size)


def with_total(df: DataFrame, key: str, aggregates: list[Column], label: str = "TOTAL",
               flag: str = "is_total") -> DataFrame:
    """Aggregate per key and add the grand-total row."""
    rolled = df.rollup(key).agg(F.grouping(key).cast("boolean").alias(flag), *aggregates)
    return rolled.withColumn(key, F.when(F.col(flag), F.lit(label)).otherwise(F.col(key)))


def spread(column: Column, values: list, measure: Column, name) -> list[Column]:
    """One conditional sum per known value: a pivot whose columns are fixed in advance."""
    return [
        F.sum(F.when(column == F.lit(v), measure).otherwise(F.lit(0))).alias(name(i, v))
        for i, v in enumerate(values)
    ]


def labelled_groups(df: DataFrame, key: str, measure: str, *, blank: str = ref.BLANK_GROUP) -> DataFrame:
    """Count and value per group; a blank or missing key is one labelled group."""
    label = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(blank)).alias("label")
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"), F.sum(measure).alias("value"))


def top_groups(df: DataFrame, key: str, measure: str, *, by: str = "value", k: int = 10,
               blank: str = ref.BLANK_GROUP) -> DataFrame:
    """The ``k`` largest groups by count or value, each with its share of the largest."""
    top = labelled_groups(df, key, measure, blank=blank).orderBy(F.desc(by), "label").limit(k)
    largest = F.max(by).over(Window.partitionBy())
    share = F.when(largest > 0, F.col(by).cast("double") / largest.cast("double") * 100).otherwise(0.0)
    return top.withColumn("share_pct", share)


def mean_or_zero(c: Column) -> Column:
    """Average of the non-null values, 0 when there is none."""
    return F.coalesce(F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)), F.lit(0.0))


def percent_label(part: Column, whole: Column) -> Column:
    """``12.5%``, rounded half up; ``0%`` when there is nothing to divide by."""
    tenths = F.floor(part.cast("double") * 1000 / F.nullif(whole, F.lit(0)) + 0.5) / 10
    return F.when(whole != 0, F.concat(F.format_string("%.1f", tenths), F.lit("%"))).otherwise("0%")
