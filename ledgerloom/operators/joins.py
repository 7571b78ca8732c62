"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str, columns: dict[str, str] | list[str], key: str = "id") -> DataFrame:
    """Columns of a dimension under a role: ``{prefix}_key`` plus the renamed attributes."""
    names = columns if isinstance(columns, dict) else {c: f"{prefix}_{c}" for c in columns}
    return df.select(F.col(key).alias(f"{prefix}_key"), *[F.col(c).alias(n) for c, n in names.items()])


def look_up(fact: DataFrame, dim: DataFrame, fk: str | Column, prefix: str,
            columns: dict[str, str] | list[str], key: str = "id", spread_nulls_by: str | None = None,
            small: bool = False) -> DataFrame:
    """Left join one role of a dimension and drop its key.

    ``small`` says that the dimension is known to fit the session's broadcast limit (``sizes.fits``): Spark's own estimate
    of a joined frame multiplies the sizes of its tables and would shuffle the fact instead. Other sides are left to Spark.

    Rows without a foreign key would all meet in one shuffle partition. With ``spread_nulls_by``
    they get stand-in keys, made from that column, that no dimension row has.
    """
    side = prefixed(dim, prefix, columns, key)
    side = F.broadcast(side) if small else side
    fk = F.col(fk) if isinstance(fk, str) else fk
    if spread_nulls_by:
        number = F.pmod(F.xxhash64(spread_nulls_by), F.lit(2**20))
        if side.schema[f"{prefix}_key"].dataType.typeName() == "string":
            stand_in = F.concat(F.lit("\x00"), number.cast("string"))
        else:
            stand_in = number - F.lit(2**62)
        fk = F.coalesce(fk, stand_in)
    return fact.join(side, fk == F.col(f"{prefix}_key"), "left").drop(f"{prefix}_key")


def attach(fact: DataFrame, keys: DataFrame, dim: DataFrame, fk: str, prefix: str, columns: dict[str, str],
           key: str = "id", by: str = "id", small: bool = False, header: DataFrame | None = None,
           header_key: str | None = None) -> DataFrame:
    """Left join one role of a large dimension to a wide fact that is keyed by ``by``.

    ``keys`` are the narrow rows (``by``, ``fk``) of the same fact. They meet the dimension first, only those that have a
    foreign key; what they found then joins the fact on ``by``. However many roles are attached, the wide rows are shuffled
    once, by their own key, which no value crowds. A dimension known to fit the broadcast limit (``small``) is looked up
    directly.

    ``header`` completes the rows of ``dim`` by ``header_key``, a column of both: the order of a line. Only the lines that the
    keys found meet their headers, so that the texts of a header are not shuffled with every line there is.
    """
    if small:
        dim = dim if header is None else dim.join(header, header_key, "left")
        return look_up(fact, dim, fk, prefix, columns, key, small=True)
    pairs = keys.select(F.col(by).alias(f"{prefix}_by"), F.col(fk).alias(f"{prefix}_fk")).filter(F.col(f"{prefix}_fk").isNotNull())
    own = {c: n for c, n in columns.items() if header is None or c in dim.columns}
    if header is not None:
        own[header_key] = f"{prefix}_header"
    found = pairs.join(prefixed(dim, prefix, own, key), F.col(f"{prefix}_fk") == F.col(f"{prefix}_key"))
    if header is not None:
        rest = {c: n for c, n in columns.items() if c not in own}
        found = look_up(found, header, f"{prefix}_header", f"{prefix}_of", rest, header_key)
    found = found.select(f"{prefix}_by", *columns.values())
    return fact.join(found, F.col(by) == F.col(f"{prefix}_by"), "left").drop(f"{prefix}_by")


def found_for(pairs: DataFrame, dim: DataFrame, by: str, fk: str) -> DataFrame:
    """The rows of ``dim`` for every pair of ``by`` and ``fk`` of a wide fact, together with ``by``.

    ``dim`` holds ``fk`` and what is wanted. The pairs alone, each once, go to it and come back to where the fact is by its own
    key ``by``; the fact joins them on both columns, and its wide rows are shuffled once, however many dimensions it meets.
    """
    narrow = pairs.select(by, fk).filter(F.col(by).isNotNull() & F.col(fk).isNotNull())
    return narrow.repartition(F.col(fk)).distinct().join(dim, fk).repartition(F.col(by))


def stay(found: DataFrame, fact: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Inner or left join of ``fact`` with rows that ``found_for`` has dealt by the first column of ``on``.

    Spark deals the fact as the first side is dealt, unless the fact is together by that column already.
    """
    both = found.join(fact, on, {"inner": "inner", "left": "right"}[how])
    return both.select(*fact.columns, *[c for c in found.columns if c not in on])


def join_in_place(fact: DataFrame, pairs: DataFrame, dim: DataFrame, by: str, fk: str, how: str = "inner",
                  small: bool = False) -> DataFrame:
    """Join ``dim`` on ``fk`` to a wide fact that is, or is going to be, together by its own key ``by``.

    ``pairs`` are narrow rows that hold every ``by`` and ``fk`` of the fact. A dimension known to fit the broadcast limit
    (``small``) is sent to the fact; in another one, rows without ``by`` find nothing.
    """
    if small:
        return fact.join(F.broadcast(dim), fk, how)
    return stay(found_for(pairs, dim, by, fk), fact, [by, fk], how)


def busy_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """The keys that hold more than an eighth of an average part's rows: at most 8 x ``parts`` of them."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * 8 * parts > total).select(key)


def many_to_many(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """Inner join on ``key`` where a key may have many rows on both sides; its pairs are spread over all tasks.

    The rows of a busy key are dealt over slices by their id, on the side or sides where they are many, and the rows of the
    other side are repeated for each slice. So the pairs of one key make a grid of cells, and a cell is one join key. Busy
    keys are found by counts; there are at most 8 x shuffle partitions of them on a side, which bounds what is broadcast.
    Rows without a key match nothing.
    """
    slices = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = left.filter(F.col(key).isNotNull()), right.filter(F.col(key).isNotNull())
    marks = {"_many_left": busy_keys(left, key, slices), "_many_right": busy_keys(right, key, slices)}

    def dealt(df: DataFrame, own: str, own_id: str, other: str) -> DataFrame:
        for mark, keys in marks.items():
            df = df.join(F.broadcast(keys.withColumn(mark, F.lit(True))), key, "left")
        number = F.pmod(F.xxhash64(own_id), F.lit(slices)).cast("int")
        repeats = F.when(F.col(other).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(slices - 1)))
        cells = df.withColumn(f"{own}_slice", F.when(F.col(own).isNull(), F.lit(0)).otherwise(number))
        return cells.withColumn(f"{other}_slice", F.explode(repeats)).drop(*marks)

    cell = [key, "_many_left_slice", "_many_right_slice"]
    both = dealt(left, "_many_left", left_id, "_many_right").join(dealt(right, "_many_right", right_id, "_many_left"), cell)
    return both.drop(*cell[1:])


def either_key_join(fact: DataFrame, dim: DataFrame, first: str, second: str,
                    columns: dict[str, str], key: str = "id", position: str | None = None) -> DataFrame:
    """Left join ``dim`` on ``key = first OR key = second`` where ``key`` is unique in ``dim``.

    Each side is matched by its own equi-join; the distinct matches then become rows. A row
    without any match stays once with nulls, one with two different matches appears twice. The
    OR predicate itself would leave a nested-loop join as the only strategy. ``position`` names
    a column that is 0 on the first row made of an input row and 1 on the second.
    """
    attrs = [F.col(c) for c in columns]
    matches = []
    for name, fk in (("_m1", first), ("_m2", second)):
        side = dim.select(F.col(key).alias(f"{name}_key"), F.struct(F.col(key).alias("_key"), *attrs).alias(name))
        fact = fact.join(side, F.col(fk) == F.col(f"{name}_key"), "left").drop(f"{name}_key")
        matches.append(F.col(name))
    found = F.array_distinct(F.array_compact(F.array(*matches)))
    rows = fact.select("*", F.posexplode_outer(found).alias("_pos", "_match"))
    out = {n: F.col(f"_match.{c}") for c, n in columns.items()}
    if position:
        out[position] = F.coalesce("_pos", F.lit(0))
    return rows.withColumns(out).drop("_m1", "_m2", "_pos", "_match")


def fan_out(base: DataFrame, joined: DataFrame, key: str) -> DataFrame:
    """Keys whose row count differs between a table and the result of joining to it."""
    before = base.groupBy(key).agg(F.count(F.lit(1)).alias("base_rows"))
    after = joined.groupBy(key).agg(F.count(F.lit(1)).alias("joined_rows"))
    both = before.join(after, key, "full")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("base_rows", "joined_rows")}
    return both.withColumns(counts).filter("base_rows <> joined_rows")
