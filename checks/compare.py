"""Run queries in Spark and their SQL in DuckDB over the same tables and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from .oracles import all_sql
from .queries import REGISTRY

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def settled(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(settled(row[i]) for i in order) for row in rows)


def differences(con, spark: SparkSession, folder: str, name: str) -> str:
    """Empty when the query and its SQL give the same rows, else what differs."""
    df = REGISTRY[name](spark, folder)
    mine = rows_of(df.columns, df.collect())
    cursor = con.execute(all_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns: {sorted(set(df.columns) ^ set(columns))}"
    if mine == theirs:
        return ""
    only_mine, only_theirs = list((mine - theirs).elements()), list((theirs - mine).elements())
    head = f"{len(only_mine)} of {sum(mine.values())} rows only in Spark, {len(only_theirs)} of {sum(theirs.values())} only in SQL"
    sample = [f"\n   spark {sorted(only_mine, key=str)[:1]}", f"\n   sql   {sorted(only_theirs, key=str)[:1]}"]
    return f"{head}\n   {sorted(df.columns)}{''.join(sample)}"


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name in names or REGISTRY:
        if name not in all_sql():
            print(f"{name:34s} no SQL")
            continue
        start = time.time()
        try:
            problem = differences(con, spark, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        print(f"{name:34s} {'DIFF ' + problem if problem else 'ok'} {time.time() - start:.1f}s", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
