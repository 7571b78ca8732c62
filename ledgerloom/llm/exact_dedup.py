"""Exact duplicates by content sort.

Normalised texts are range-partitioned by sampled splitters, sorted externally inside each partition, and neighbours are
compared in full: a window over (head, hash, slice, text) starts a new group wherever the whole text differs from its
neighbour's. The window's keys begin with the range keys, so Spark adds no second shuffle: each text moves once.

* The splitters are drawn from short keys (the first 32 characters, a 64-bit hash), never from whole texts, so that the
  sample the driver sees is small however long the texts are. The hash only orders; equality is decided on the text.
* A text held by more rows than an eighth of an average partition is cut into slices by document id. There can be at most
  8 x partitions such texts, which bounds what is broadcast. Each slice gives its smallest id and count; the slices of a
  text, at most one per partition, are then sorted and compared the same way.

Cases: a null text is an empty one; null ids sort last; of rows that share text and id one is kept; other columns are
ignored, whatever their names; an empty table gives no rows. A text of any length is one sort record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, cut, shuffle_width


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    slices = shuffle_width(spark)
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ").alias("body"),
    ).withColumn("h", F.xxhash64("body"))

    busy = max(16, docs.count() // (8 * slices))
    hot = texts.groupBy("h").count().filter(F.col("count") > busy).select("h", F.lit(True).alias("hot"))  # <= 8 x slices rows
    placed = (
        texts.join(F.broadcast(hot), "h", "left")
        .withColumn("hot", F.coalesce("hot", F.lit(False)))
        .withColumn("slice", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(slices))).otherwise(F.lit(0)).cast("int"))
        .withColumn("head", F.substring("body", 1, 32))
    )
    ranged = placed.repartitionByRange(slices, "head", "h", "slice")
    equal = Window.partitionBy("head", "h", "slice", "body").orderBy(F.col("doc_id").asc_nulls_last())
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sorted_rows = ranged.select(
        "doc_id", "h", "hot", "slice", "head", "body",
        F.row_number().over(equal).alias("place"),
        F.min("doc_id").over(whole).alias("least"),
        F.count(F.lit(1)).over(whole).alias("held"),
    )
    marked = cut(sorted_rows.select(
        "doc_id", "h", "hot", "slice", "place", "least", "held",
        F.sha2("body", 256).alias("text_sha256"),
        F.when(F.col("hot") & (F.col("place") == 1), F.col("body")).alias("lead_text"),
    ))
    single = marked.filter(~F.col("hot")).select(
        "doc_id", F.col("least").alias("keep_id"), F.col("held").alias("group_size"), (F.col("place") == 1).alias("kept"),
        "text_sha256",
    )
    leads = (
        marked.filter(F.col("hot") & (F.col("place") == 1))
        .withColumn("lead_head", F.substring("lead_text", 1, 32))
        .repartitionByRange(slices, "lead_head", "h")
    )
    same = Window.partitionBy("lead_head", "h", "lead_text").orderBy(F.col("least").asc_nulls_last(), "slice")
    all_slices = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    resolved = leads.select(
        "text_sha256", "slice",
        F.min("least").over(all_slices).alias("keep_id"),
        F.sum("held").over(all_slices).alias("group_size"),
        (F.row_number().over(same) == 1).alias("first_slice"),
    )
    sliced = (
        marked.filter(F.col("hot")).select("doc_id", "slice", "place", "text_sha256")
        .join(resolved, ["text_sha256", "slice"])
        .select("doc_id", "keep_id", "group_size", (F.col("first_slice") & (F.col("place") == 1)).alias("kept"), "text_sha256")
    )
    return single.unionByName(sliced)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns; ids must be unique here, as they tell the rows apart."""
    stay = exact_groups(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias("__keep"))
    return docs.join(stay, docs[id_col].eqNullSafe(F.col("__keep")), "left_semi")
