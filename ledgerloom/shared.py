"""The folder that driver and executors share, and frames that are written to it once and read from there."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: The session setting by which the shuffle files of a query go when it ends, instead of when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files behind. For frames that nothing else reads."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; only a local session may go without that setting."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="shared-"))
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared folder and read from there.

    For a sub-plan that several parts of a query read: it runs once, survives lost executors, and the parts see the same
    rows even where the sub-plan is not repeatable (a sampled range partition).
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
