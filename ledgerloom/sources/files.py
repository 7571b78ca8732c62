"""Report files and log files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings of report files.
REPORT_ENDINGS = (".xlsx", ".csv", ".json")


def report_files(spark: SparkSession, folder: str, endings=REPORT_ENDINGS) -> DataFrame:
    """Name, change time and size of the report files below a folder. Contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", "modificationTime", "length")
    )
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    pattern = "(?:" + "|".join(e.replace(".", r"\.") for e in endings) + ")$"
    return files.filter(name.rlike(pattern)).select(
        name.alias("file_name"),
        F.col("modificationTime").cast("timestamp_ntz").alias("mtime"),
        F.col("length").alias("size_bytes"),
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with the file they come from (files of several folders may share a name) and a position that
    follows the file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("mtime"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seen"),
        "value",
    )
    # Lines of one block are read in order by one task, and blocks follow their start offset.
    position = F.col("_block") * F.lit(2**20) + F.col("_seen") % F.lit(2**33)
    return lines.select("file_path", "file_name", "mtime", position.alias("line_no"), "value")
