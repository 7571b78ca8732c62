"""Repeated runs of lines: a suffix array over line-ID sequences by prefix doubling, and its common-prefix intervals.

Lines are named by 128 bits of hash; the suffixes of a document are the sequences of names from each of its lines on, in order
of document and line. Prefix doubling ranks them by 1, 2, 4, ... lines: a rank is the place of the pair (own rank, rank as many
lines further on) among the sorted pairs, which sampled splitters range-partition. A suffix that shares its rank with no other
leaves, since its longest common prefix with any other is shorter; doubling ends when none is left.

Suffixes that share a rank are an interval of the suffix array with a common prefix of that many lines. Between two rounds an
interval splits into parts that have twice the prefix in common; one suffix of each part, the first in order, goes on as its
representative and tells by halving how far the parts agree with each other: d lines are shared where the ranks of 2^k lines
(2^k <= d < 2^(k+1)) agree at the start and at d - 2^k. Halving ends with the interval's longest common prefix. Of the suffixes
that end in an interval, all but the first are later copies of its prefix, and no earlier suffix has more in common with them.
So every suffix gets the length of the longest run that begins at it and also begins earlier; runs that lie inside the run of
the line before are left out, and what stays are the maximal repeated runs.

Later copies of maximal runs of at least `min_words` words go, whole, even of a single line; shorter runs, such as a greeting,
stay wherever they stand.

Ranks and intervals come from grouped counts (a line that is everywhere is one row for each task) and go back to their
suffixes by joins, which Spark splits on hot lines. The one text shuffle joins the runs of a document to its text.

Cases: a null text is an empty one, with a single empty line; a document whose lines all go has an empty text; rows that
repeat an id are told apart by their text, and of rows equal in both one is the first copy; null ids come last in the
order; an empty table gives no rows. The lines and the runs of a document are arrays in the last step. A document has at most
2^24 lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, shuffle_width, written

_DOC = ["doc", "copy", "twin"]
#: Stands for a null id, after all others.
_LAST = (1 << 63) - 1
#: Bits of a place that hold the line: it is the number of the document in the order, then the line.
_LINE_BITS = 24


def _ranked(keys: DataFrame, names: list[str]) -> DataFrame:
    """Distinct keys and their other columns with `rank`, their place in order: the range partition, then the place inside it."""
    parts = keys.repartitionByRange(shuffle_width(keys.sparkSession), *names).withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("part").orderBy(*names)
    place = F.shiftleft(F.col("part").cast("long"), 40) + F.row_number().over(inside)
    return written(parts.select(*keys.columns, place.alias("rank")))


def _shared(suffixes: DataFrame, names: list[str]) -> DataFrame:
    """Keys that several suffixes have, with the first of these."""
    known = suffixes.filter(F.col(names[-1]).isNotNull())
    return known.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).filter("n > 1").drop("n")


def _suffixes(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """The suffixes whose first line others begin with too: `at`, `rank`, `first`."""
    keys = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    known = lines.join(_ranked(keys, ["h1", "h2"]), ["h1", "h2"]).join(numbers, _DOC)
    own = written(known.select((F.shiftleft("number", _LINE_BITS) + F.col("pos")).alias("at"), "rank"))
    return own.join(own.groupBy("rank").agg(F.min("at").alias("first")), "rank")


def common_prefixes(lines: DataFrame, numbers: DataFrame) -> DataFrame:
    """For each suffix that shares lines with an earlier one: its place `at`, `n`, the most lines so shared, and `first`, the
    place of the first suffix that shares them; lines: document, `pos` and the hashes `h1`, `h2` of the line."""
    suffixes = written(_suffixes(lines, numbers))
    level, found, halves, ranks = 0, [], [], []
    while not suffixes.isEmpty():
        ahead = suffixes.select((F.col("at") - (1 << level)).alias("at"), F.col("rank").alias("rank2"))
        pairs = suffixes.withColumnRenamed("first", "head").join(ahead, "at", "left")
        keys = _shared(pairs, ["rank", "rank2"]).withColumnsRenamed({"rank": "own", "rank2": "further"})
        same = (F.col("rank2") == F.col("further")) & (pairs["rank"] == F.col("own"))
        deeper = _ranked(keys, ["own", "further"]).withColumnRenamed("rank", "deep")
        split = written(pairs.join(deeper, same, "left").select("at", "rank", "head", "first", "deep"))
        # One suffix of each part stays in the interval; it has between 2^level and 2^(level + 1) - 1 lines in common there.
        stay = split.filter("first IS NULL OR first = at").select("at", F.col("head").alias("first"))
        if level:
            halves.append(stay.select("at", "first", F.lit(level).alias("level"), F.lit(1 << level).alias("low"), F.lit(2 << level).alias("high")))
            ranks.append(suffixes.select("at", "rank", F.lit(level).alias("level")))
        else:
            found.append(stay.filter("first <> at").select("at", "first", F.lit(1).alias("n")))
        suffixes, level = split.filter("deep IS NOT NULL").select("at", F.col("deep").alias("rank"), "first"), level + 1
    if halves:
        found.append(_halved(_all(halves), _all(ranks), level - 1))
    return _all(found) if found else suffixes.select("at", "first", F.lit(1).alias("n"))


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _halved(rows: DataFrame, ranks: DataFrame, rounds: int) -> DataFrame:
    """Representatives with the longest prefix that they share with an earlier one of their interval."""
    node, there = ["head", "level", "low", "high"], ranks.select(F.col("at").alias("there"), "level", F.col("rank").alias("rank2"))
    for _ in range(rounds):
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        asked = rows.withColumn("middle", F.when(F.col("high") - F.col("low") > 1, middle)).withColumn(
            "there", F.col("at") + F.col("middle") - F.call_function("shiftleft", F.lit(1), F.col("level")))
        asked = written(asked.join(there, ["there", "level"], "left").drop("there").withColumnRenamed("first", "head"))
        split = asked.join(_shared(asked, [*node, "rank2"]), [*node, "rank2"], "left")
        # A suffix goes on in the part that it shares with others, and as the first of its part in the interval itself.
        state = lambda first, low, high: F.struct(first.alias("first"), F.col("level"), low.alias("low"), high.alias("high"))
        goes_on = F.array_compact(F.array(
            F.when(F.col("first").isNotNull(), state(F.col("first"), F.col("middle"), F.col("high"))),
            F.when(F.col("first").isNull() | (F.col("first") == F.col("at")), state(F.col("head"), F.col("low"), F.coalesce("middle", "high")))))
        rows = written(split.select("at", F.explode(goes_on).alias("x")).select("at", "x.*"))
    return rows.filter("first <> at").select("at", "first", F.col("low").alias("n"))


def line_names(texts: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    """Documents, `pos` and hashes of all lines."""
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    own = texts.select(*[F.col(f"{prefix}{c}").alias(c) for c in _DOC], F.posexplode(split).alias("pos", "line"))
    return own.select(*_DOC, "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def maximal_runs(texts: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    """Later copies of maximal repeated runs: document, `pos` of the first line, `n` lines, place of the earliest copy as
    `first_doc` (an id) and `first_pos`."""
    lines = line_names(texts, text_col, prefix)
    numbers = _ranked(texts.select(*[F.col(f"{prefix}{c}").alias(c) for c in _DOC]), _DOC)
    # The numbers of ranks leave no room for lines: parts and rows of a part take 39 bits together.
    number = F.shiftleft(F.shiftright("rank", 40), 25) + F.col("rank").bitwiseAND(F.lit((1 << 40) - 1))
    numbers = numbers.select(*_DOC, number.alias("number"))
    runs = written(common_prefixes(lines, numbers))
    inside = runs.select((F.col("at") + 1).alias("at"), (F.col("n") - 1).alias("n"))
    line = F.lit((1 << _LINE_BITS) - 1)
    runs = runs.join(inside, ["at", "n"], "left_anti").select(
        F.shiftright("at", _LINE_BITS).alias("number"), F.col("at").bitwiseAND(line).cast("int").alias("pos"), "n",
        F.shiftright("first", _LINE_BITS).alias("first_number"), F.col("first").bitwiseAND(line).cast("int").alias("first_pos"))
    firsts = numbers.select(F.col("number").alias("first_number"), F.col("doc").alias("first_doc"))
    return runs.join(numbers, "number").join(firsts, "first_number").drop("number", "first_number")


def _named(docs: DataFrame, id_col: str, text_col: str, prefix: str) -> DataFrame:
    """The documents with what tells their rows apart: id, hash of the text, number among rows equal in both."""
    doc, copy = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)), F.xxhash64(text_col)
    unique = docs.groupBy(doc.alias("id")).count().filter("count > 1").isEmpty()
    twin = F.lit(0) if unique else F.row_number().over(Window.partitionBy(doc, copy).orderBy(F.xxhash64(*docs.columns)))
    return docs.withColumns({f"{prefix}doc": doc, f"{prefix}copy": copy, f"{prefix}twin": twin})


def free_prefix(columns: list[str]) -> str:
    """A beginning of names that no column has."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each later copy of a maximal repeated run: doc_id, start (line from 0), n_lines, first_id, first_start.

    Null ids are null again. Whether a run is long enough to go is not asked here.
    """
    only = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    runs = maximal_runs(_named(only, "id", "text", ""), "text")
    known = lambda c: F.nullif(c, F.lit(_LAST))
    return runs.select(known(F.col("doc")).alias("doc_id"), F.col("pos").cast("long").alias("start"), F.col("n").cast("long").alias("n_lines"),
                       known(F.col("first_doc")).alias("first_id"), F.col("first_pos").cast("long").alias("first_start"))


def without_repeats(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text", prefix: str = "__") -> DataFrame:
    """All columns of the documents and, with `prefix`, n_lines, n_removed and kept (the text of the lines that stay).

    `prefix` begins no column of the documents.
    """
    p = prefix
    texts = _named(docs, id_col, text_col, p)
    runs = maximal_runs(texts, text_col, p)
    by_doc = runs.groupBy(*_DOC).agg(F.collect_list(F.struct("pos", "n")).alias(f"{p}runs")).withColumnsRenamed({c: f"{p}{c}" for c in _DOC})
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    words = F.transform(f"{p}lines", lambda x: F.size(F.filter(F.split(x, SPACES), lambda w: w != "")))
    marked = texts.join(by_doc, [f"{p}{c}" for c in _DOC], "left").withColumn(f"{p}lines", split)
    marked = marked.withColumn(f"{p}words", F.when(F.col(f"{p}runs").isNotNull(), words))
    long = F.filter(f"{p}runs", lambda r: F.aggregate(F.slice(F.col(f"{p}words"), r["pos"] + 1, r["n"]), F.lit(0), lambda a, b: a + b) >= min_words)
    dead = F.array_distinct(F.flatten(F.transform(long, lambda r: F.sequence(r["pos"], r["pos"] + r["n"] - 1))))
    marked = marked.withColumn(f"{p}dead", dead)
    stay = F.array_except(F.sequence(F.lit(0), F.size(f"{p}lines") - 1), f"{p}dead")
    kept = F.array_join(F.transform(stay, lambda k: F.element_at(F.col(f"{p}lines"), k + 1)), "\n")
    removed = F.coalesce(F.size(f"{p}dead"), F.lit(0))
    return marked.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(f"{p}lines").cast("long").alias(f"{p}n_lines"),
        F.greatest(removed, F.lit(0)).cast("long").alias(f"{p}n_removed"),
        F.when(removed > 0, kept).otherwise(F.coalesce(F.col(text_col), F.lit(""))).alias(f"{p}kept"),
    )


def drop_repeats(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The documents, all columns, without later copies of long runs of lines; a document of which nothing stays goes.

    The number of characters follows the text where there is such a column.
    """
    p = free_prefix(docs.columns)
    found = without_repeats(docs, min_words, id_col, text_col, p)
    cut_ = F.col(f"{p}n_removed") > 0
    found = found.filter(~(cut_ & (F.trim(f"{p}kept") == ""))).withColumn(text_col, F.when(cut_, F.col(f"{p}kept")).otherwise(F.col(text_col)))
    if size_col in docs.columns:
        size = F.length(text_col).cast(docs.schema[size_col].dataType)
        found = found.withColumn(size_col, F.when(cut_, size).otherwise(F.col(size_col)))
    return found.select(*docs.columns)


def report(docs: DataFrame, min_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept_sha256."""
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return without_repeats(only, min_words).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.sha2("__kept", 256).alias("kept_sha256"))
