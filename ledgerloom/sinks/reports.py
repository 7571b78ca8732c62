"""Report output: sections and nested documents; dated runs are in ``runs``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV parts with a header and every field quoted; a quote inside a field is doubled."""
    (df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"')
     .option("encoding", "UTF-8").csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per row; null fields are written."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


_WRITERS = {
    "csv": write_csv,
    "json": write_json,
    "parquet": lambda df, path, mode="overwrite": df.write.mode(mode).parquet(path),
}


def write_report(sections: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """A report of several sections, one dataset per section."""
    for name, df in sections.items():
        _WRITERS[fmt](df, f"{folder}/{name}")
