"""Read and write round trips."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.sinks import reports, runs
from ledgerloom.sources import files, layout, loose, tables


def test_text_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('product,quantity,total_value\n"a ""b"", c",12.5x,\n\nz,,7\n"two\nlines",n/a,1\n')
    rows = loose.text_csv(spark, str(path), ["product", "quantity", "total_value"], ["quantity", "total_value"], multi_line=True).collect()
    assert [tuple(r) for r in rows] == [('a "b", c', 12.5, 0.0), ("z", 0.0, 7.0), ("two\nlines", 0.0, 1.0)]


def test_csv_columns_by_header(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b,a\n1,x\n")
    assert loose.text_csv(spark, str(path), ["a", "b"], ["b"]).collect() == [("x", 1.0)]
    assert loose.text_csv(spark, str(path)).columns == ["b", "a"]
    with pytest.raises(ValueError):
        loose.text_csv(spark, str(path), ["a", "c"])


def test_headers_and_aliases(spark):
    assert loose.normal_header("Qty  On/Hand (u)") == "qty_on_hand_u"
    df = spark.createDataFrame([("A", "", 0.0, 5.0, "3"), ("B", "cat", 2.0, 0.0, "")],
                               "`Product Name` string, Category string, `Qty On Hand` double, `On Hand` double, `Reorder Min` string")
    out = [r.asDict() for r in loose.inventory_sheet(df).orderBy("product").collect()]
    assert [(r["qty_on_hand"], r["qty_available"], r["reorder_point"], r["level"]) for r in out] == [
        (5.0, 5.0, 3.0, "ok"), (2.0, 2.0, 0.0, "ok")]
    assert list(loose.normalise_headers(df.toDF("a b", "A/B", "c", "d", "e")).columns) == ["a_b", "c", "d", "e"]


def test_parquet_tables_check_columns(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/res_currency")
    with pytest.raises(ValueError, match="missing columns"):
        tables.parquet_tables(spark, str(tmp_path))["res_currency"]
    with pytest.raises(KeyError):
        tables.parquet_tables(spark, str(tmp_path))["unknown"]


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("ERP_DB_USER", "u")
    source = tables.Jdbc("jdbc:postgresql://db/erp", splits={"stock_move": tables.JdbcSplit("id", "1", "900", 16)})
    options = source.options("stock_move")
    assert options["user"] == "u" and options["numPartitions"] == "16" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in source.options("res_currency")


def test_parameterised_query(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, k string")
    out = tables.query(spark, "SELECT id FROM {t} WHERE array_contains(:keys, k) AND id > :low", {"t": df}, keys=["a", "c"], low=1)
    assert [r["id"] for r in out.collect()] == [3]


def test_file_listing_and_logs(spark, tmp_path):
    (tmp_path / "a_20240101_0101.csv").write_text("12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.json").write_text("{}")
    (tmp_path / "c.txt").write_text("no")
    got = {r["file_name"]: r["size_bytes"] for r in files.report_files(spark, str(tmp_path)).collect()}
    assert got == {"a_20240101_0101.csv": 5, "b.json": 2}
    log = tmp_path / "job.log"
    log.write_text("one\ntwo ERROR\nthree\n")
    rows = files.log_lines(spark, str(log)).orderBy("line_no").collect()
    assert [(r["file_name"], r["value"]) for r in rows] == [("job.log", "one"), ("job.log", "two ERROR"), ("job.log", "three")]


def test_report_sections(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you', None)], "id int, t string, n string").coalesce(1)
    reports.write_report({"one": df, "two": df.drop("n")}, str(tmp_path / "csv"), "csv")
    part = next(p for p in (tmp_path / "csv" / "one").iterdir() if p.suffix == ".csv")
    assert part.read_text().splitlines()[0] == '"id","t","n"' and '"say ""hi"", you"' in part.read_text()
    reports.write_report({"one": df}, str(tmp_path / "json"), "json")
    part = next(p for p in (tmp_path / "json" / "one").iterdir() if p.suffix == ".json")
    assert json.loads(part.read_text()) == {"id": 1, "t": 'say "hi", you', "n": None}


def test_dated_runs(spark, tmp_path):
    path = str(tmp_path / "mart")
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    with pytest.raises(FileNotFoundError):
        runs.read_run(spark, path)
    assert runs.write_run(spark.range(2), path, first).rows == 2
    runs.write_run(spark.range(3), path, second)
    runs.write_run(spark.range(5), path, first)  # a date done again: replaced, and not the latest
    assert runs.read_run(spark, path).agg(F.count("*"), F.max("run_date")).first() == (3, second)
    assert runs.read_run(spark, path, first).agg(F.count("*"), F.max("run_date")).first() == (5, first)
    assert runs.published(spark, path).rows == 3


def test_half_written_runs_are_not_seen(spark, tmp_path):
    path, day, later = str(tmp_path / "mart"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    runs.write_run(spark.range(2), path, day)
    run = runs.write_data(spark.range(9), path, later)  # ends before it is published
    with pytest.raises(Exception, match="stop"):
        runs.write_run(spark.range(4).select(F.expr("if(id = 3, raise_error('stop'), id)").alias("id")), path, later)
    assert runs.read_run(spark, path).count() == 2 and runs.published(spark, path).run_date == "2024-01-01"
    with pytest.raises(FileNotFoundError):
        runs.read_run(spark, path, later)
    runs.publish(spark, path, run)
    assert runs.read_run(spark, path).count() == 9
    assert sorted(n for n in os.listdir(f"{path}/runs") if not n.startswith(".")) == ["2024-01-01.json", "2024-01-02.json", "latest.json"]


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    orders = spark.range(400).selectExpr("id", "concat('P', id) AS name")
    lines = spark.range(2_000).selectExpr("id", "id % 410 AS order_id")
    names = layout.write_bucketed({"purchase_order": orders, "purchase_order_line": lines}, str(tmp_path / "layout"), 4,
                                  {"purchase_order": "id", "purchase_order_line": "order_id"})
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        heads, rows = spark.table(names["purchase_order"]), spark.table(names["purchase_order_line"])
        joined = rows.join(heads.withColumnRenamed("id", "order_id"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == lines.join(orders.withColumnRenamed("id", "order_id"), "order_id").count()
        assert len([n for n in os.listdir(tmp_path / "layout" / "purchase_order_line") if n.endswith(".parquet")]) == 4
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
        for name in names.values():
            spark.sql(f"DROP TABLE {name}")


def test_buckets_grow_with_the_tables(spark):
    orders, lines = spark.range(400).selectExpr("id"), spark.range(2_000).selectExpr("id", "id % 400 AS order_id")
    tables, keys = {"purchase_order": orders, "purchase_order_line": lines}, {"purchase_order": "id", "purchase_order_line": "order_id"}
    assert layout.bucket_count(tables, 8, 100, keys) == 20 and layout.bucket_count(tables, 8, 99, keys) == 21
    assert layout.bucket_count(tables, 8, keys=keys) == 8
    assert layout.bucket_count({"purchase_order": orders.limit(0)}, 8, 100, {"purchase_order": "id"}) == 8
