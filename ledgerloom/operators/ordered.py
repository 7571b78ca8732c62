"""Order-dependent operators that keep a hot key spread over tasks.

A window partitioned by a key pulls every row of that key into one task. Row numbers therefore come from a range partition
by sampled splitters and the counts of its parts. Look-ahead cuts each key by a *bucket* — any expression that never decreases
along the order, such as the hour of a timestamp: windows run per (key, bucket), and one summary row per bucket carries what
crosses a bucket border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import settled


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key. Each task keeps its own first ``n`` before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``: latest, earliest or first seen."""
    return top_n_per_key(df, keys, order, 1, "_rank").drop("_rank")


def range_sorted(df: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows range-partitioned and sorted by ``order``, with ``_part`` and ``_local`` (place in the part, from 1), and for
    each part the number of rows before it (``_part``, ``_before``, ``_rows``).

    Splitters are sampled from the whole order, tie-breaks included, so rows that share a date or an amount are spread like
    any others. The sorted rows are written to the shared folder once: counts and rows come from the same splitters. There
    are as many parts as the session has shuffle partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    # The id is the number of the part and, in its lower 33 bits, the place in it.
    rows = settled(in_order).withColumns({
        "_part": F.shiftright("_at", 33), "_local": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1}).drop("_at")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    return rows, counts.select("_part", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, order: list[Column], name: str = "row_no", keys: tuple[str, ...] = ()) -> DataFrame:
    """Row number in ``order`` over the whole frame, or per key.

    No window holds more than a row for each part: a row's number is its place in its part and the rows of the parts before.
    With ``keys`` the frame is sorted by them first, and a number counts from the first row of its key. Select the columns
    that are needed before: the sorted rows are written with all that they carry.
    """
    rows, parts = range_sorted(df, [*[F.col(k) for k in keys], *order])
    out = rows.join(F.broadcast(parts), "_part").withColumn(name, F.col("_before") + F.col("_local"))
    out = out.select(*df.columns, name)
    if keys:
        first = out.groupBy(*keys).agg(F.min(name).alias("_first")).withColumnsRenamed({k: f"_key_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
        out = out.join(first, same).withColumn(name, F.col(name) - F.col("_first") + 1).select(*df.columns, name)
    return out


def with_next(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column,
              name: str = "next_value") -> DataFrame:
    """``value`` of the following row of the same key, null on its last row.

    ``value`` must be non-null. The last row of a bucket takes the first value of the next one.
    """
    cut = df.withColumn("_bucket", bucket)
    firsts = cut.groupBy(*keys, "_bucket").agg(F.min_by(F.col(value), F.struct(*order)).alias("_first"))
    following = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bucket"))
    firsts = firsts.select(*keys, "_bucket", following.alias("_next_first"))
    local = F.lead(value).over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return (
        cut.withColumn("_local", local).join(firsts, [*keys, "_bucket"])
        .withColumn(name, F.coalesce("_local", "_next_first"))
        .drop("_bucket", "_local", "_next_first")
    )


def ranked_union(first: DataFrame, others: DataFrame, key: str, rank: str, n: int) -> DataFrame:
    """A priority list followed by the others in key order, each key once, at most ``n`` rows."""
    top = first.select(key, F.lit(0).alias("_list"), F.col(rank).cast("bigint").alias("_rank"))
    rest = others.select(key).distinct().select(key, F.lit(1).alias("_list"), F.lit(0).cast("bigint").alias("_rank"))
    best = top.unionByName(rest).groupBy(key).agg(F.min(F.struct("_list", "_rank")).alias("_p"))
    return best.orderBy("_p._list", "_p._rank", key).limit(n)
