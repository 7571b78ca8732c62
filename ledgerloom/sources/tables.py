"""ERP tables from parquet, a database, or parameterised SQL."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import TABLES
from .sizes import TableSize, row_bytes, table_size


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns of a table with their declared types; fail on a missing one."""
    declared = TABLES[table]
    missing = [c for c in declared if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*[
        F.col(c) if kind == "key" else F.col(c).cast(kind).alias(c) for c, kind in declared.items()
    ])


class Tables(Mapping):
    """ERP tables by name, read when first asked for; ``size`` tells how large one is, without running anything."""

    def __init__(self, load: Callable[[str], DataFrame], names=tuple(TABLES), size: Callable[[str], TableSize | None] | None = None):
        self._load, self._names, self._size = load, tuple(names), size
        self._seen: dict[str, DataFrame] = {}
        self._sizes: dict[str, TableSize | None] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._seen:
            self._seen[name] = conform(self._load(name), name)
        return self._seen[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)

    def size(self, name: str) -> TableSize | None:
        """Rows and row width of a table as it was read here; None where unknown."""
        if self._sizes.get(name) is None:  # one unknown under a low broadcast limit may be told under another
            self._sizes[name] = self._size(name) if self._size else None
        return self._sizes[name]


def parquet_tables(spark: SparkSession, folder: str) -> Tables:
    """One parquet dataset per table: ``{folder}/{table}``."""
    seen: dict[str, DataFrame] = {}

    def load(name: str) -> DataFrame:
        if name not in seen:
            seen[name] = spark.read.parquet(f"{folder}/{name}")
        return seen[name]

    return Tables(load, size=lambda name: table_size(load(name)))


def catalog_tables(spark: SparkSession, database: str) -> Tables:
    """Tables of the session's catalog; those that have been analysed (``ANALYZE TABLE``) have known sizes."""
    return Tables(lambda name: spark.table(f"{database}.{name}"), size=lambda name: table_size(spark.table(f"{database}.{name}")))


@dataclass(frozen=True)
class JdbcSplit:
    """How a base table is cut into parallel reads: a numeric or date column and its range."""

    column: str
    low: str
    high: str
    parts: int


@dataclass(frozen=True)
class Jdbc:
    """A database to read base tables from. Credentials come from the environment."""

    url: str
    user_variable: str = "ERP_DB_USER"
    password_variable: str = "ERP_DB_PASSWORD"
    fetch_size: int = 10_000
    splits: dict[str, JdbcSplit] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)  # declared, of tables that are to be sent to all tasks

    def options(self, table: str) -> dict[str, str]:
        out = {
            "url": self.url,
            "dbtable": table,
            "user": os.environ.get(self.user_variable, ""),
            "password": os.environ.get(self.password_variable, ""),
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        split = self.splits.get(table)
        if split:
            out |= {"partitionColumn": split.column, "lowerBound": split.low,
                    "upperBound": split.high, "numPartitions": str(split.parts)}
        return out


def jdbc_tables(spark: SparkSession, source: Jdbc) -> Tables:
    """Base tables of a database; projections and simple filters are pushed down to it."""
    def load(name: str) -> DataFrame:
        return spark.read.format("jdbc").options(**source.options(name)).load()

    def size(name: str) -> TableSize | None:
        return TableSize(source.rows[name], row_bytes(load(name).schema)) if name in source.rows else None

    return Tables(load, size=size)


def query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None, **params) -> DataFrame:
    """Parameterised SQL: ``:name`` markers take values, ``{name}`` takes a table.

    A list value is bound as an array; test it with ``array_contains(:names, column)``.
    """
    args = {k: F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else v for k, v in params.items()}
    return spark.sql(sql, args=args, **(tables or {}))
