"""Operators against brute force on small frames, with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import distinct, explore, groups, joins, ordered
from ledgerloom.sources import sizes, tables


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(9)}", rng.randrange(500)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "id int, k string, at int").cache()


@pytest.mark.parametrize("keys, descending", [(["k"], False), (["k"], True), ([], False)])
def test_numbered(events, keys, descending):
    rows, df = events
    order = [F.desc("at"), F.desc("id")] if descending else [F.col("at"), F.col("id")]
    out = ordered.numbered(df, order, "n", tuple(keys)).collect()
    want = {}
    for group in ({r[1] for r in rows} if keys else {None}):
        members = sorted((r for r in rows if group is None or r[1] == group), key=lambda r: (r[2], r[0]), reverse=descending)
        want |= {r[0]: n for n, r in enumerate(members, 1)}
    assert {r["id"]: r["n"] for r in out} == want


def test_numbered_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    out = ordered.numbered(df, [F.col("id")], "n", ("k",))
    assert {r["id"]: r["n"] for r in out.collect()} == {1: 1, 2: 2, 3: 1}


def test_with_next(events):
    rows, df = events
    out = ordered.with_next(df, ["k"], ["at", "id"], "at", F.floor(F.col("at") / 20), "nxt")
    want = {}
    for k in {r[1] for r in rows}:
        chain = sorted((r[2], r[0]) for r in rows if r[1] == k)
        want |= {a[1]: b[0] if b else None for a, b in zip(chain, [*chain[1:], None])}
    assert {r["id"]: r["nxt"] for r in out.collect()} == want


def test_one_per_key(events):
    rows, df = events
    out = ordered.one_per_key(df, ["k"], [F.desc("at"), F.desc("id")]).collect()
    assert {r["k"]: r["id"] for r in out} == {k: max((r[2], r[0]) for r in rows if r[1] == k)[1] for k in {r[1] for r in rows}}


def test_latest_needs_one_row_per_key_and_task(events):
    plan = ordered.one_per_key(events[1], ["k"], [F.desc("at"), F.desc("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_ranked_union(spark):
    first = spark.createDataFrame([("z", 0), ("b", 1)], "m string, place int")
    others = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "m string")
    assert [r["m"] for r in ordered.ranked_union(first, others, "m", "place", 3).collect()] == ["z", "b", "a"]


OR_CASES = [(1, 10, 10), (2, 10, 20), (3, 10, None), (4, None, None), (5, 99, 20), (6, 98, 99)]


def test_either_key_join_equals_or_join(spark):
    fact = spark.createDataFrame(OR_CASES, "id int, a int, b int")
    dim = spark.createDataFrame([(10, "x"), (20, "y")], "id int, name string")
    plan = fact.alias("f").join(dim.alias("d"), (F.col("a") == F.col("d.id")) | (F.col("b") == F.col("d.id")), "left")
    want = sorted(plan.select("f.id", "name").collect(), key=str)
    got = joins.either_key_join(fact, dim, "a", "b", {"name": "name"}, position="no")
    assert sorted(got.select("id", "name").collect(), key=str) == want
    assert {(r["id"], r["name"]): r["no"] for r in got.collect()}[2, "y"] == 1
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("ddl, keys", [("id int, fk bigint", [1, None, 3, None]), ("id int, fk string", ["1", None, "3", None])])
def test_look_up_spreads_missing_keys(spark, ddl, keys):
    fact = spark.createDataFrame(list(enumerate(keys)), ddl)
    dim = spark.createDataFrame([(keys[0], "one")], ddl.split(", ")[1].replace("fk", "id") + ", name string")
    got = joins.look_up(fact, dim, "fk", "d", {"name": "name"}, spread_nulls_by="id")
    assert got.columns == ["id", "fk", "name"]
    assert sorted(got.collect()) == sorted([(0, keys[0], "one"), (1, None, None), (2, keys[2], None), (3, None, None)])


def test_fan_out(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    joined = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    out = joins.fan_out(base, joined, "id").orderBy("id").collect()
    assert [tuple(r) for r in out] == [(2, 1, 2), (3, 1, 0)]


def test_list_parts_hold_every_value_in_order(spark):
    short = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "x"), (3, None)], "k int, v string")
    links = short.unionByName(spark.range(50_500).select(F.lit(4).alias("k"), F.concat(F.lit("v"), "id").alias("v")))
    parts = groups.list_parts(links, ["k"], "v").collect()
    assert {r["k"]: (r["part_no"], r["n_parts"], r["n_values"], r["values"]) for r in parts if r["k"] < 4} == {
        1: (0, 1, 2, ["a", "b"]), 2: (0, 1, 1, ["x"])}
    long = sorted((r for r in parts if r["k"] == 4), key=lambda r: r["part_no"])
    assert [v for r in long for v in r["values"]] == sorted(f"v{i}" for i in range(50_500))
    assert [len(r["values"]) for r in long] == [groups.PART_SIZE] * 50 + [500]
    assert {(r["n_parts"], r["n_values"]) for r in long} == {(51, 50_500)}


def test_list_cells_say_what_they_leave_out(spark):
    links = spark.createDataFrame([(k, f"v{i:02}") for k in (1, 2) for i in range(3 if k == 1 else 40)] * 2, "k int, v string")
    cells = {r["k"]: (r["n"], r["names"]) for r in groups.list_cell(links, ["k"], "v", "names", "n", part_size=5).collect()}
    assert cells == {1: (3, "v00, v01, v02"), 2: (40, "v00, v01, v02, v03, v04, … +35")}
    arrays = {r["k"]: r["names"] for r in groups.list_cell(links, ["k"], "v", "names", "n", separator=None, part_size=5).collect()}
    assert arrays == {1: ["v00", "v01", "v02"], 2: ["v00", "v01", "v02", "v03", "v04"]}


def test_list_cells_join_no_numbers_of_whole_lists(spark):
    """Lists are not sorted again to meet their number; a missing key has no list, a list of just a part is whole."""
    links = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), *[(3, f"v{i}") for i in range(5)], *[(4, f"v{i}") for i in range(6)]],
                                  "k int, v string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        cells = groups.list_cell(links, ["k"], "v", "names", "n", part_size=5)
        assert "SortMergeJoin" not in cells._jdf.queryExecution().sparkPlan().toString()
        assert {r["k"]: (r["n"], r["names"]) for r in cells.collect()} == {
            1: (1, "a"), 3: (5, "v0, v1, v2, v3, v4"), 4: (6, "v0, v1, v2, v3, v4, … +1")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_total_row_and_spread(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 2, 5), ("b", 0, 2), (None, 0, 4)], "k string, w int, x int")
    columns = groups.spread(F.col("w"), [0, 1, 2], F.col("x"), lambda i, _: f"w{i}")
    out = {r["k"]: tuple(r)[1:] for r in groups.with_total(df, "k", [*columns, F.sum("x").alias("all")]).collect()}
    assert out == {"a": (False, 1, 0, 5, 6), "b": (False, 2, 0, 0, 2), None: (False, 4, 0, 0, 4), "TOTAL": (True, 7, 0, 5, 12)}


def test_top_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 3.0), (None, 3.0), ("b", 2.0)], "k string, v double")
    out = [tuple(r) for r in groups.top_groups(df, "k", "v", k=2).collect()]
    assert out == [("(sin dato)", 2, 6.0, 100.0), ("b", 1, 2.0, 2.0 / 6.0 * 100)]


def test_ratio_and_mean(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0)], "a int, b double")
    row = df.agg(groups.mean_or_zero(F.col("b")), groups.percent_label(F.lit(1), F.lit(8)),
                 groups.percent_label(F.lit(0), F.lit(0)), groups.mean_or_zero(F.lit(None).cast("double"))).first()
    assert tuple(row) == (4.0, "12.5%", "0%", 0.0)


def test_pages(spark):
    df = spark.range(95).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("gap"))
    for order, by in ((["-v", "id"], [F.desc("v"), F.col("id")]), (["gap", "-id"], [F.col("gap"), F.desc("id")])):
        whole = [r["id"] for r in df.orderBy(*by).collect()]
        for number, expected in ((1, whole[:10]), (5, whole[40:50]), (10, whole[90:]), (99, whole[90:]), (0, whole[:10])):
            page = explore.page(df, order, number, 10)
            assert [r["id"] for r in page.collect()] == expected and page.columns == df.columns
    assert explore.page(df.limit(0), ["-v", "id"], 3, 10).collect() == []


def test_one_hot_date_is_spread(spark):
    """All rows share the leading sort value: the parts are cut within it."""
    df = spark.range(40_000).select(F.lit("2024-01-01").cast("date").alias("day"), F.xxhash64("id").alias("h"), "id")
    rows, parts = ordered.range_sorted(df, [F.desc("day"), F.col("h"), F.col("id")])
    sizes = [r["_rows"] for r in parts.collect()]
    assert sum(sizes) == 40_000 and len(sizes) == 4 and max(sizes) < 2 * 10_000
    got = [r["id"] for r in ordered.numbered(df, [F.desc("day"), F.col("h"), F.col("id")], "n").orderBy("n").collect()]
    assert got == [r["id"] for r in df.orderBy("h", "id").collect()]


def test_facets_and_search(spark):
    df = spark.createDataFrame([(1, "a", None, "X y"), (2, "b", "a", None), (3, "b", "c", "zz")], "id int, v string, p string, t string")
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(explore.facet(df, {("v", "p"): "a", "t": ""})) == [1, 2]
    assert ids(explore.facet(df, {"v": "b", "p": None})) == [2, 3]
    assert ids(explore.search(df, "A X", ["v", "t"])) == [1]
    assert ids(explore.search(df, "", ["v"])) == [1, 2, 3]
    assert [r["value"] for r in explore.facet_values(df, "p").collect()] == ["a", "c"]


def test_broadcast_depends_on_size(spark, tmp_path):
    """A side is sent to all tasks only where the catalogue says that it fits; it is read off files, without a job."""
    path = str(tmp_path)
    fact = spark.range(10).withColumnRenamed("id", "fk")
    columns = {"id": "bigint", "name": "string", "phone": "string", "email": "string", "vat": "string"}

    def dim(rows):
        return spark.range(rows).selectExpr("id", "uuid() AS name", *[f"'x' AS {c}" for c in list(columns)[2:]])

    def planned(t):
        joined = joins.look_up(fact, t["res_partner"], "fk", "d", {"name": "name"}, small=sizes.fits(t, "res_partner"))
        return "strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()

    dim(5000).write.parquet(f"{path}/res_partner")
    t = tables.parquet_tables(spark, path)
    t["res_partner"]
    spark.sparkContext.setJobGroup("sizes", "no job may run")
    size = t.size("res_partner")
    assert size.rows == 5000 and size.row_bytes >= 8 * len(columns)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        whole = size.rows * size.row_bytes
        for limit, expected in ((whole, True), (whole - 1, False), (-1, False), (0, False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
            assert planned(t) == expected
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(whole))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("sizes")
        dim(10).write.mode("append").parquet(f"{path}/res_partner")  # the table grows: read anew it has its new size
        grown = tables.parquet_tables(spark, path)
        assert grown.size("res_partner").rows == 5010 and not planned(grown)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not sizes.fits({"res_partner": t["res_partner"]}, "res_partner")  # of a plain frame nothing is known
    declared = tables.Jdbc("jdbc:x", rows={"res_partner": 7})
    assert declared.rows["res_partner"] == 7


def test_size_settings():
    assert [sizes.byte_size(x) for x in ("10485760b", "10MB", "-1", "256k", "1g")] == [10485760, 10485760, -1, 262144, 1 << 30]


def test_analysed_tables_have_sizes(spark):
    spark.sql("CREATE TABLE sized_partners USING parquet AS SELECT id, uuid() AS name FROM range(300)")
    try:
        spark.sql("ANALYZE TABLE sized_partners COMPUTE STATISTICS")
        assert sizes.table_size(spark.table("sized_partners")).rows == 300
    finally:
        spark.sql("DROP TABLE sized_partners")


def test_attached_roles(spark):
    """Documents found by narrow keys equal a plain left join; rows without a key stay."""
    fact = spark.createDataFrame([(i, None if i % 3 == 0 else i % 5) for i in range(60)], "id int, fk int")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (4, None)], "id int, name string")
    want = sorted(joins.look_up(fact, dim, "fk", "d", {"name": "who"}).collect(), key=str)
    for small in (False, True):
        got = joins.attach(fact, fact, dim, "fk", "d", {"name": "who"}, small=small)
        assert got.columns == ["id", "fk", "who"] and sorted(got.collect(), key=str) == want


def test_many_to_many_spreads_a_busy_key(spark):
    """A key with a third of the moves and many tasks: all pairs, and no task with over twice the median."""
    moves = spark.range(6_000).select(F.col("id").alias("move"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400 + 10).alias("k"))
    tasks = spark.range(900).select(F.col("id").alias("task"), F.when(F.col("id") < 300, 7).when(F.col("id") < 880, F.col("id") % 400 + 10).alias("k"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
            spark.conf.set(c, v)
        pairs = joins.many_to_many(moves, tasks, "k", "move", "task")
        sizes_ = sorted(r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert pairs.select("move", "task").distinct().count() == moves.join(tasks, "k").count() == sum(sizes_)
        assert len(sizes_) == 4 and sizes_[-1] < 2 * (sizes_[1] + sizes_[2]) / 2
        assert sorted(map(tuple, pairs.filter("k <> 7").collect())) == sorted(
            map(tuple, moves.join(tasks, "k").filter("k <> 7").select(*pairs.columns).collect()))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_bitmaps_count_distinct_values(spark):
    df = spark.range(5_000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), (F.col("id") * 31 % 977))).otherwise("").alias("v"))
    numbers = distinct.numbers_of(df, "v")
    assert sorted(r["_no"] for r in numbers.collect()) == list(range(numbers.count()))
    bits = distinct.bitmaps(df, ["k"], "v", numbers)
    want = {r["k"]: r["n"] for r in df.filter("v <> ''").groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    assert {r["k"]: r["n"] for r in distinct.bit_counts(bits, ["k"], "n").collect()} == want
    odd = distinct.bit_counts(distinct.merged(bits, [(F.col("k") % 2).alias("odd")]), ["odd"], "n").collect()
    assert {r["odd"]: r["n"] for r in odd} == {r["odd"]: r["n"] for r in df.filter("v <> ''").groupBy((F.col("k") % 2).alias("odd")).agg(
        F.countDistinct("v").alias("n")).collect()}


def test_attached_lines_meet_their_headers_last(spark):
    """Lines found by narrow keys and completed by their headers equal a plain left join."""
    fact = spark.createDataFrame([(i, None if i % 3 == 0 else i % 5) for i in range(60)], "id int, fk int")
    lines = spark.createDataFrame([(1, 7, "a"), (2, 8, "b"), (2, 9, "c"), (4, None, "d")], "id int, head int, name string")
    heads = spark.createDataFrame([(7, "x"), (8, "y"), (8, "z")], "head int, title string")
    columns = {"name": "line", "title": "of"}
    want = sorted(joins.look_up(fact, lines.join(heads, "head", "left"), "fk", "d", columns).collect(), key=str)
    for small in (False, True):
        got = joins.attach(fact, fact, lines, "fk", "d", columns, small=small, header=heads, header_key="head")
        assert got.columns == ["id", "fk", "line", "of"] and sorted(got.collect(), key=str) == want


def shuffled_with(plan, column):
    """The shuffles of a plan that carry a column."""
    plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    kids = [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.nodeName() == "Exchange" and f"{column}#" in plan.output().toString()
    return sum((shuffled_with(k, column) for k in kids), int(own))


def test_wide_rows_are_shuffled_once_for_two_dimensions(spark):
    """Pairs go to the dimensions instead of the wide rows, with the rows of plain joins where keys repeat or are missing."""
    fact = spark.createDataFrame([(i % 7 or None, i % 5 or None, i % 3 or None, f"wide {i % 30}") for i in range(80)],
                                 "order_id int, a int, b int, text string")
    one = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (4, None), (None, "z")], "a int, first string")
    two = spark.createDataFrame([(1, "p"), (1, "q"), (None, "z")], "b int, second string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.join_in_place(fact, fact, one, "order_id", "a")
        got = joins.join_in_place(got, fact, two, "order_id", "b", "left")
        plain = fact.filter("order_id is not null").join(one, "a").join(two, "b", "left").select(*got.columns)
        assert got.columns == ["order_id", "a", "b", "text", "first", "second"]
        assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
        assert shuffled_with(got._jdf.queryExecution().executedPlan(), "text") == 1
        assert shuffled_with(plain._jdf.queryExecution().executedPlan(), "text") == 2
        small = joins.join_in_place(fact, fact, two, "order_id", "b", "left", small=True)
        assert sorted(small.collect(), key=str) == sorted(fact.join(two, "b", "left").select(*small.columns).collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
