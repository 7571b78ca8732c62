"""What the text operators share: the tables, the folder for cut lineage, slices of Arrow text, sums of sparse counts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space, tab and the line ends: the white space that separates words in every operator here.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that the cluster names in `spark.checkpoint.dir`.

    Only a local session, where every task runs on this machine, may go without that setting.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder and read from there, so that later steps survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: The session setting by which a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, freed: bool = False) -> DataFrame:
    """`df` written once as a table in the shared folder and read from there.

    For rounds of joins: a checkpoint keeps Spark's estimate of its size, which is a product of the sizes joined, so that the
    number grows twice as long with each round; a table has the size of its files.

    ``freed`` removes the shuffle files of ``df`` when the table is written, for a frame that nothing else reads: a shuffle of
    whole texts would else stay on disk until the driver collects garbage.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    try:
        if freed:
            conf.set(_CLEANUP, "true")
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id's decimal text, modulo `of`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(of)


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a batch in runs of rows of about `most_bytes`: first row, bytes of the run, row offsets into them.

    A null text is an empty one. A longer text makes a run of its own.
    """
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    size, place = (np.int64, 8) if pa.types.is_large_string(texts.type) else (np.int32, 4)
    rows = len(texts)
    if not rows:
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=size, count=rows + 1, offset=texts.offset * place).astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most_bytes, side="right")) - 1)
        yield first, whole[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        first = last


def row_slices(texts: list[str | None], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows (first, past the last) whose texts have about `most` characters together, one row at least."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > most:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of numpy arrays, lists or Arrow arrays."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
