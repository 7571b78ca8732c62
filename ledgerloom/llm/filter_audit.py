"""What filters of documents remove, keep and lose, for every order in which they may be applied, by contingency tensors.

Five filters (see `conditions`) give each document a pattern of five bits. The patterns of a part (a source) are counted, as
are those of its good and of its toxic documents: three tensors of 2 x 2 x 2 x 2 x 2, pass or fail along each axis. A step of
an order is a choice for each axis: the filters before it pass, its own fails, those after it are either. So each figure is
one contraction of a tensor with a selection vector per axis, [1, 0] for pass, [0, 1] for fail and [1, 1] for all, and all
600 steps of the 120 orders are one `einsum` over the part. No document is touched again.

The texts never move. What moves is one short row per document: to its label, to the rows of its text (by SHA-256, counted
before the shuffle, so that a text of a third of all rows is a few rows a task), and to its pattern.

Cases: a null text is an empty one, which has no words and fails only A and, where an earlier one exists, E; a null part is
an empty string; a null id is no smaller and no larger than any other, so such rows never fail E and have no label; rows
that share id and text do not make each other fail; of several labels of an id, one that says 1 counts; an empty table gives
no rows; other columns are ignored. Texts are read whole, of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, batch_of, cut

LETTERS = "ABCDE"
_SIZE = 1 << len(LETTERS)
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_STEPS = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(c, pa.int64()) for c in _COUNTS]])
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)


def conditions(text: str, words: str, least: int = 200, distinct: int = 50, capitals: int = 2, marks: str = "[#$%&*|]") -> list[Column]:
    """When the filters A to D fail: few words, repeated words, many capitals, marks. E is about other texts.

    `text` and `words` name columns: the text and the array of its words.
    """
    count = F.size(words)
    return [
        count < least,
        100 * F.size(F.array_distinct(words)) < distinct * count,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > capitals * F.length(text),
        F.col(text).rlike(marks),
    ]


def patterns(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
             good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """part, pattern (bit k is set where filter k fails) and the number of all, good and toxic documents."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    words = rows.withColumn("words", F.filter(F.split("text", SPACES), lambda w: w != ""))
    bits = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(conditions("text", "words"))), F.lit(0))
    facts = cut(words.select("doc", "part", F.unhex(F.sha2("text", 256)).alias("body"), bits.alias("bits")))  # a short row each
    known = labels.select(F.col(id_col).cast("long").alias("doc"), F.col(good_col).alias("good"), F.col(toxic_col).alias("toxic")).filter("doc IS NOT NULL")
    marks = known.groupBy("doc").agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("good", "toxic")])
    plain = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    keys = ["body", "part", "bits", "good", "toxic"]
    with_id = (
        facts.filter("doc IS NOT NULL").join(marks, "doc", "left").select("doc", "part", "body", "bits", plain("good"), plain("toxic"))
        .groupBy("doc", *keys).agg(F.count(F.lit(1)).alias("n"))
        # Of the documents of a text, part and label: all rows, and the rows of the smallest id.
        .groupBy(*keys).agg(F.sum("n").alias("n"), F.min(F.struct("doc", "n")).alias("least"))
    )
    earliest = with_id.groupBy("body").agg(F.min("least.doc").alias("earliest"))
    first = F.when(F.col("least.doc") == F.col("earliest"), F.col("least.n")).otherwise(F.lit(0))
    split = with_id.join(earliest, "body").select("part", "bits", "good", "toxic", "n", first.alias("first"))
    unnamed = facts.filter("doc IS NULL").groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "bits", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n", F.col("n").alias("first"))
    both = split.unionByName(unnamed).select(
        "part", "good", "toxic",
        F.explode(F.array(F.struct(F.col("bits").alias("pattern"), F.col("first").alias("n")),
                          F.struct((F.col("bits") + F.lit(16)).alias("pattern"), (F.col("n") - F.col("first")).alias("n")))).alias("x"),
    )
    n = F.col("x.n")
    return both.groupBy("part", F.col("x.pattern").alias("pattern")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def selections() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The (order, step) of all steps, and for each figure what each step selects along each axis (step, axis, 2)."""
    steps = [("".join(o), k + 1) for o in permutations(LETTERS) for k in range(len(LETTERS))]
    place = np.array([[o.index(x) for x in LETTERS] for o, _ in steps])
    now = np.array([[k - 1] for _, k in steps])
    earlier, own, later = place < now, place == now, place > now

    def chosen(at_earlier: tuple, at_own: tuple, at_later: tuple) -> np.ndarray:
        return sum(mask[:, :, None] * np.array(which, np.int64) for mask, which in ((earlier, at_earlier), (own, at_own), (later, at_later)))

    return steps, {
        "kept": chosen(_PASS, _PASS, _ALL), "removed": chosen(_PASS, _FAIL, _ALL), "fails": chosen(_ALL, _FAIL, _ALL),
        "unique_fails": chosen(_PASS, _FAIL, _PASS),
    }


def contracted(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The sum that each step selects from a tensor of 2 x 2 x 2 x 2 x 2."""
    return np.einsum("abcde,sa,sb,sc,sd,se->s", tensor, *np.moveaxis(chosen, 1, 0), optimize="greedy")


def audited(counts: DataFrame) -> DataFrame:
    """All steps of all orders for each part; counts: part, pattern, n, good, toxic."""
    tensors = counts.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))  # 32 at most

    def steps_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, chosen = selections()
        own = np.array([o[k - 1] for o, k in steps])
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                flat = np.zeros((3, _SIZE), np.int64)
                for cell in cells:
                    flat[:, cell["pattern"]] = cell["n"], cell["good"], cell["toxic"]
                # Bit 0 of a pattern is filter A: the last axis of the reshaped counts, so the axes are turned round.
                every, good, toxic = (t.reshape((2,) * len(LETTERS)).transpose() for t in flat)
                kept, removed, fails, unique = (contracted(every, chosen[c]) for c in ("kept", "removed", "fails", "unique_fails"))
                shapley = sum(np.where(own == x, removed[own == x].sum(), 0) for x in LETTERS)
                yield batch_of(
                    _STEPS, [part] * len(steps), [o for o, _ in steps], [k for _, k in steps], kept, removed, fails - removed,
                    unique, contracted(good, chosen["removed"]), contracted(toxic, chosen["removed"]), shapley)

    return tensors.mapInArrow(steps_of, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step: part, filter_order, step and the counts."""
    return audited(patterns(docs, labels))
