"""Every registered query against its SQL, and what must hold for whole marts."""

import os

import pytest
from pyspark.sql import functions as F

from checks import compare, oracles, views
from checks.queries import REGISTRY, bill_headers, order_lines
from ledgerloom.plans import cash, payables, projects, purchasing, stock

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

NO_SQL = set()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.fixture(scope="module")
def t(spark):
    return views.erp(spark, FOLDER)


def test_every_query_has_sql_or_a_reason():
    assert set(REGISTRY) - set(oracles.all_sql()) == NO_SQL and set(oracles.all_sql()) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - NO_SQL))
def test_query_equals_sql(con, spark, name):
    assert compare.differences(con, spark, FOLDER, name) == ""


def test_all_entities_decoded(spark):
    import html
    import re
    got = {r["page_id"]: r["plain"] for r in REGISTRY["clean_html_all_entities"](spark, FOLDER).collect()}
    for r in views.source(spark, FOLDER, "pages").collect():
        text = re.sub(r"<br\s*/?>|</p>", "\n", html.unescape(r["html"]), flags=re.I)
        text = re.sub(r"\n\s*\n", "\n", re.sub(r"<[^>]+>", "", text)).strip()
        assert got[r["page_id"]] == re.sub(" +", " ", text).strip()


def test_weekly_overtime_and_search_depths_show_in_the_data(spark):
    assert REGISTRY["week_overtime"](spark, FOLDER).filter("total_hours > 0").groupBy("week_start").count().count() == 2
    depths = [REGISTRY[f"search_terms{mode}"](spark, FOLDER).groupBy("query_id").count().agg(F.max("count")).first()[0]
              for mode in ("_fast", "", "_deep")]
    assert depths == [3, 5, 10]


def test_keys_do_not_repeat(t):
    for df, key in ((purchasing.po_lines(t, compare_day()), "line_id"), (bill_headers(t), "bill_id"),
                    (projects.project_tasks(t), "task_id"), (stock.move_documents(t), "movement_id")):
        assert df.count() == df.select(key).distinct().count()


def compare_day():
    from checks.queries import DAY
    return DAY


def test_sections_make_up_the_whole(t):
    lines = order_lines(t)
    assert sum(df.count() for df in purchasing.split_states(lines).values()) == lines.count()
    heads = bill_headers(t)
    assert payables.unpaid(heads).count() + payables.paid(heads).count() == heads.count()
    weekly = cash.weekly_cash_flow(cash.cash_requirements(t), compare_day())
    total = cash.cash_totals(weekly).filter("is_total").first()
    assert total["total_gtq"] == weekly.agg(F.sum("total_gtq")).first()[0] and weekly.count() == 13


def test_plans_have_no_nested_loops(spark):
    for name in ("stock_movements", "po_lines", "project_tasks", "message_search", "project_hierarchy", "cash_requirements"):
        plan = REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan, name


def test_plans_run_no_job_and_agree_without_broadcasts(con, spark):
    """Nothing runs while the movements are planned; shuffled, spread joins give the same rows as those by broadcast."""
    REGISTRY["stock_movements"](spark, FOLDER)  # the tables are read once
    spark.sparkContext.setJobGroup("planning", "no job may run")
    REGISTRY["stock_movements"](spark, FOLDER)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert compare.differences(con, spark, FOLDER, "stock_movements") == ""
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
