"""A training corpus from the documents table: language, repeated lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as Parquet in
the shared checkpoint folder and read again as the documents of the next stage. All but the last keep the columns of
documents. Stages keep rows whatever other columns they carry.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, language, line_dedup, packing, simhash
from ledgerloom.llm.common import remainder, shared_folder, table
from ledgerloom.llm.queries import MIN_WORDS, RADIUS, SHINGLE, tokenizer_path


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay."""
    return language.keep_recognised(docs, remainder("doc_id", 4) == 2)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of long runs of lines go; a document of which nothing is left goes with them."""
    return line_dedup.drop_repeats(docs, MIN_WORDS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_copies(docs, SHINGLE, RADIUS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack(docs, tokenizer_path(), 1024, 0)


STAGES = [
    ("language", recognised),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", near_copies),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: SQL can state neither the language model nor the fingerprints: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
