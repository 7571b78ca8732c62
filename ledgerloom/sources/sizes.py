"""How large tables are, without running a job: a catalogue for choosing the joins whose one side is sent to all tasks.

The rows of a table come from its statistics where it has been analysed, else from the footers of its Parquet files, or they
are declared (a database). The width of a row is that of its columns in memory, and no less than what its files hold for
each row. Nothing is remembered beyond the table's frame, which has its own list of files: a frame read anew after the table
changed has the new size.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

_FIXED_WIDTH = {"byte", "short", "integer", "long", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}
#: Bytes taken for a text or nested value where nothing is known about it; of a row besides its columns.
TEXT_BYTES, ROW_BYTES = 48, 16
#: Footers that the driver opens for one table; one with more files counts as large until it has been analysed.
MOST_FILES = 64
_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40}


class TableSize(NamedTuple):
    """Rows of a table (at most) and bytes of a row in memory (about)."""

    rows: int
    row_bytes: int


def byte_size(text: str) -> int:
    """A size setting such as ``10485760b`` or ``10MB`` in bytes."""
    number = text.strip().lower().rstrip("bkmgt")
    return int(number) << _UNITS[text.strip().lower()[len(number):]]


def broadcast_limit(df: DataFrame) -> int:
    """The session's limit for the side of a join that goes to all tasks; below zero there is none."""
    return byte_size(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def row_bytes(schema: StructType) -> int:
    """Bytes that a row takes in memory by the types of its columns."""
    width = {"decimal": 16} | dict.fromkeys(_FIXED_WIDTH, 8)
    return ROW_BYTES + sum(width.get(f.dataType.typeName(), 8 + TEXT_BYTES) for f in schema.fields)


def table_size(df: DataFrame) -> TableSize | None:
    """Size of a table just as it was read, None where it cannot be told without a job."""
    spark, width = df.sparkSession, row_bytes(df.schema)
    known = df._jdf.queryExecution().optimizedPlan().stats()
    if known.rowCount().isDefined():
        return TableSize(int(str(known.rowCount().get())), width)
    files = df.inputFiles() if int(str(known.sizeInBytes())) <= max(0, broadcast_limit(df)) else []
    if not files or len(files) > MOST_FILES:  # files beyond the limit hold more than it in memory
        return None
    parquet, hadoop = spark._jvm.org.apache.parquet.hadoop, spark._jvm.org.apache.hadoop.fs
    rows = held = 0
    for name in files:
        file = parquet.util.HadoopInputFile.fromPath(hadoop.Path(name), spark._jsc.hadoopConfiguration())
        footer = parquet.ParquetFileReader.open(file)
        try:
            rows += footer.getRecordCount()
            held += sum(block.getTotalByteSize() for block in footer.getRowGroups())
        finally:
            footer.close()
    return TableSize(rows, max(width, -(-held // max(rows, 1))))


def fits(tables: Mapping[str, DataFrame], *names: str) -> bool:
    """Whether a frame surely fits the broadcast limit that has at most one row for each row of the first table, with
    columns of any of the tables. Tables of unknown size never fit.
    """
    sizes = [tables.size(name) for name in names] if hasattr(tables, "size") else [None]
    if any(s is None for s in sizes):
        return False
    return sizes[0].rows * sum(s.row_bytes for s in sizes) <= broadcast_limit(tables[names[0]])
