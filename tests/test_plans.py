"""Marts over hand-made tables: branches, boundaries and hot keys."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom import reference_data as ref
from ledgerloom.params import SEARCH_PRESETS, AsOf, BreakRule, SearchPreset
from ledgerloom.plans import attendance, cash, payables, projects, quality, search
from ledgerloom.sources.schemas import TABLES
from ledgerloom.sources.tables import Tables

DAY = dt.date(1998, 6, 15)


@pytest.fixture
def erp(spark):
    """Tables from rows given as dicts; columns not given are null, key columns are numbers."""
    def build(**rows):
        def load(name):
            kinds = {c: "bigint" if k == "key" else k for c, k in TABLES[name].items()}
            ddl = ", ".join(f"{c} {k}" for c, k in kinds.items())
            return spark.createDataFrame([tuple(r.get(c) for c in kinds) for r in rows.get(name, [])], ddl)
        return Tables(load)
    return build


# --- attendance ------------------------------------------------------------------------------

def at(day, hour, minute=0, second=0):
    """UTC timestamp of a local time in UTC−6."""
    return dt.datetime(2024, 1, day, hour, minute, second) + dt.timedelta(hours=6)


PEOPLE = dict(
    hr_employee=[dict(id=i, name=f"W{i}", department_id=0 if i < 8 else None, mobile_phone="" if i == 2 else f"+{i}",
                      active=i != 3) for i in range(1, 10)],
    hr_department=[dict(id=0, name="Obra")])
SITE = AsOf(dt.date(2024, 1, 15), at(15, 23))


def sessions(*rows):
    return [dict(id=n, employee_id=e, check_in=a, check_out=b) for n, (e, a, b) in enumerate(rows)]


def test_sessions_breaks_and_local_days(erp):
    t = erp(**PEOPLE, hr_attendance=sessions(
        (1, at(15, 8), at(15, 9)), (1, at(15, 9, 19, 59), at(15, 10)),       # 19:59 gap: no break
        (1, at(15, 10, 20), at(15, 11)),                                     # 20:00 gap: break
        (1, at(15, 13), at(15, 14)), (1, at(15, 16, 0, 1), at(15, 17)),      # 2 h gap: break; 2 h 1 s: none
        (2, at(15, 22), None), (4, at(14, 23, 30), at(15, 0, 30)), (9, at(14, 8), None)))
    rows = {(r["employee_id"], r["work_date"].day): r for r in attendance.attendance_sessions(t, SITE).collect()}
    one = rows[1, 15]
    assert one["lunch_duration"] == round((20 + 120) / 60, 2) and one["sessions"] == 5
    assert (one["first_entry"], one["last_exit"], one["is_currently_inside"]) == ("08:00:00", "17:00:00", False)
    assert rows[2, 15]["total_hours"] == 1.0 and rows[2, 15]["is_currently_inside"]
    assert (4, 14) in rows and rows[4, 14]["total_hours"] == 1.0 and (4, 15) not in rows
    assert rows[9, 14]["department"] == attendance.NO_DEPARTMENT and rows[9, 14]["total_hours"] == 0.0
    every = attendance.attendance_sessions(t, SITE, breaks=BreakRule.every_gap()).filter("employee_id = 1").first()
    gaps = dt.timedelta(minutes=19, seconds=59) + dt.timedelta(minutes=20) + dt.timedelta(hours=4, seconds=1)
    assert every["lunch_duration"] == round(gaps.total_seconds() / 3600, 2)
    replaced = attendance.attendance_sessions(t, SITE, open_hours="replace").filter("employee_id = 9").first()
    assert replaced["total_hours"] == 39.0


def test_nested_days(erp):
    t = erp(**PEOPLE, hr_attendance=sessions((1, at(15, 8), at(15, 9)), (1, at(15, 10), None)))
    row = attendance.attendance_days(t, SITE).first()
    assert [tuple(r) for r in row["clock_records"]] == [("entry", "08:00:00"), ("exit", "09:00:00"), ("entry", "10:00:00")]
    assert row["record_count"] == 3


def test_on_site_now(erp):
    t = erp(**PEOPLE, hr_attendance=sessions(
        (1, at(15, 7), at(15, 8)), (1, at(15, 12), None), (2, at(15, 10, 59, 59), None), (3, at(15, 13, 0, 0), None),
        (4, at(15, 9), None), (4, at(15, 20), at(15, 21)), (5, at(14, 20), None), (9, at(15, 9), None)))
    rows = attendance.on_site_now(t, SITE).orderBy("row_no").collect()
    assert [(r["row_no"], r["employee_id"], r["alert_level"], r["phone"]) for r in rows] == [
        (1, 2, "danger", "N/A"), (2, 1, "warning", "+1"), (3, 3, "normal", None)]
    assert rows[1]["hours_on_site"] == 11.0


def test_overtime(erp):
    week = [(1, at(d, 8), at(d, 17)) for d in (8, 9, 10, 11, 12)] + [(2, at(8, 8), None)]
    t = erp(**PEOPLE, hr_attendance=sessions(*week, (1, at(5, 8), at(5, 20))))
    period = attendance.period_attendance(t, SITE, dt.date(2024, 1, 1), dt.date(2024, 1, 14))
    weeks = attendance.week_overtime(period).collect()
    before = [(r["total_hours"], r["overtime_hours"]) for r in weeks if r["week_start"] == dt.date(2024, 1, 1)]
    assert before == [(12.0, 0.0)]  # a week of its own: its hours add no overtime to the next one
    rows = {r["employee_id"]: r for r in weeks if r["week_start"] == dt.date(2024, 1, 8)}
    assert (rows[1]["days"], rows[1]["total_hours"], rows[1]["overtime_hours"], rows[1]["missing_exits"]) == (5, 45.0, 1.0, 0)
    assert (rows[2]["total_hours"], rows[2]["overtime_hours"], rows[2]["missing_exits"]) == (0.0, 0.0, 1)


# --- cash ------------------------------------------------------------------------------------

def needs_frame(spark, rows):
    ddl = ("payment_date date, po_state string, currency string, amount_pending decimal(18,4), amount_gtq decimal(18,4), "
           "project_name string")
    return spark.createDataFrame([(d, s, c, D(p), D(g), n) for d, s, c, p, g, n in rows], ddl)


def test_weeks(spark):
    days = [DAY + dt.timedelta(days=n) for n in (-1, 0, 6, 7, 12 * 7 + 6, 13 * 7)] + [None]
    df = needs_frame(spark, [(d, "sent", "GTQ", 1, 1, "p") for d in days])
    rows = {r["week_no"]: r["count"] for r in cash.weekly_cash_flow(df, dt.date(1998, 6, 17)).collect()}
    assert len(rows) == 13 and {w: n for w, n in rows.items() if n} == {0: 3, 1: 1, 12: 1}
    late = cash.weekly_cash_flow(df, dt.date(1998, 6, 17), overdue=True).filter("week_no = -1").first()
    assert (late["week_label"], late["count"]) == ("Vencido", 1)


def test_week_amounts_by_mode(spark):
    df = needs_frame(spark, [(DAY, "draft", "GTQ", 10, 40, "a"), (DAY, "sent", "USD", 2, 77, "b"), (DAY, "to approve", None, 3, 5, "b")])
    week = cash.weekly_cash_flow(df, DAY).first()
    assert [float(week[c]) for c in ("total_gtq", "total_usd", "draft", "sent")] == [28.4, 2.0, 10.0, 15.4]
    week = cash.weekly_cash_flow(df, DAY, mode="as_reported").first()
    assert [float(week[c]) for c in ("total_gtq", "total_usd", "draft", "sent")] == [92.0, 5.0, 40.0, 77.0]


def test_cash_document(spark):
    rows = [(DAY, "draft", "GTQ", n, n, f"p{n}") for n in range(1, 8)]
    df = needs_frame(spark, rows)
    documents = cash.cash_document(cash.weekly_cash_flow(df, DAY), cash.cash_top_projects(df, DAY)).orderBy("week_start").collect()
    assert [p["project"] for p in documents[0]["top_projects"]] == ["p7", "p6", "p5", "p4", "p3"]
    assert documents[1]["top_projects"] == [] and documents[0]["by_status"]["draft"] == 28 and len(documents) == 13


def test_unpaid_counts_a_bill_once(erp):
    t = erp(purchase_order_line=[dict(id=i, order_id=1) for i in (1, 2)],
            account_move=[dict(id=9, move_type="in_invoice", state="posted", payment_state="partial", amount_residual_signed=D("10")),
                          dict(id=8, move_type="in_invoice", state="posted", payment_state="paid", amount_residual_signed=D("99"))],
            account_move_line=[dict(id=1, move_id=9, purchase_line_id=1), dict(id=2, move_id=9, purchase_line_id=2),
                               dict(id=3, move_id=8, purchase_line_id=1)])
    assert [tuple(r) for r in cash.unpaid_per_order(t).collect()] == [(1, D("10"))]
    assert [tuple(r) for r in cash.unpaid_per_order(t, per_line=True).collect()] == [(1, D("20"))]


# --- bills -----------------------------------------------------------------------------------

def test_bill_sections(erp):
    due = {1: -1, 2: 0, 3: 7, 4: 8, 5: 3, 6: 3, 7: 3}
    residual = {5: 0, 6: -4, 7: None}
    moves = [dict(id=i, name=f"B{i}", move_type="in_invoice", state="posted", partner_id=1, amount_total_signed=D("10"),
                  invoice_date_due=None if i == 2 else DAY + dt.timedelta(days=n), invoice_date=DAY,
                  amount_residual_signed=None if i == 7 else D(residual.get(i, 5))) for i, n in due.items()]
    t = erp(account_move=moves, res_partner=[dict(id=1, name="S")])
    heads = payables.bills(t, DAY)
    numbers = lambda df: sorted(r["bill_number"] for r in df.collect())
    assert numbers(payables.bills_next_days(heads, DAY)) == ["B2", "B3"]
    assert numbers(payables.unpaid(heads)) == ["B1", "B2", "B3", "B4"] and numbers(payables.paid(heads)) == ["B5", "B6"]
    assert {r["bill_number"]: r["days_overdue"] for r in heads.collect()}["B1"] == 1
    assert payables.bills(t, DAY, sign="abs").filter("bill_number = 'B6'").first()["bill_residual_signed"] == 4
    stats = payables.bill_stats(heads).first()
    assert (stats["bills"], stats["unpaid_bills"], stats["paid_bills"], stats["all_residuals_zero"]) == (7, 4, 2, False)


def test_bill_orders_fall_back_to_lines(erp):
    t = erp(purchase_order=[dict(id=i, name=f"P{i}") for i in (1, 2, 3)],
            purchase_order_line=[dict(id=i, order_id=i) for i in (1, 2, 3)],
            account_move_purchase_order_rel=[dict(account_move_id=10, purchase_order_id=2)],
            account_move_line=[dict(id=1, move_id=10, purchase_line_id=1), dict(id=2, move_id=11, purchase_line_id=3),
                               dict(id=3, move_id=11, purchase_line_id=1), dict(id=4, move_id=11, purchase_line_id=3)])
    assert sorted(map(tuple, payables.bill_orders(t).collect())) == [(10, "P2"), (11, "P1"), (11, "P3")]


# --- projects --------------------------------------------------------------------------------

def plan(erp):
    def task(i, parent, project, end, stage=1, **more):
        return dict(id=i, name=f"t{i}", parent_id=parent, project_id=project, date_deadline=end, stage_id=stage, active=True,
                    is_closed=False, sequence=1, **more)

    d = lambda n: DAY + dt.timedelta(days=n)
    return erp(
        project_project=[dict(id=1, name='{"es_GT":"Uno"}', active=True, date_start=d(0), date=d(9)),
                         dict(id=2, active=True), dict(id=3, active=False)],
        project_task_type=[dict(id=1, name='{"es_GT":"Abierto"}'), dict(id=2, name='{"es_GT":"Hecho"}'),
                           dict(id=3, name='{"es_GT":"Bloqueado"}')],
        project_task=[task(10, None, 1, d(5)), task(11, 10, 1, d(2), 3), task(12, 11, 1, d(1)), task(13, None, 1, None),
                      task(14, 10, 2, d(1)), task(15, None, 2, d(-3), 2), task(16, 15, 2, d(4)), task(17, None, 3, d(0)),
                      task(18, 10, 1, None, fecha_inicio=d(0))])


def test_hierarchy_shows_two_levels_in_order(erp):
    rows = projects.project_hierarchy(plan(erp), DAY).orderBy(*projects.hierarchy_order()).collect()
    assert [(r["id"], r["level"]) for r in rows] == [
        ("P2", 0), ("15", 1), ("16", 2), ("P1", 0), ("10", 1), ("11", 2), ("18", 2), ("13", 1)]
    by_id = {r["id"]: r for r in rows}
    assert by_id["P2"]["name"] == "PROJECT 2" and by_id["P1"]["days"] == 10 and by_id["11"]["name"] == "  → t11"
    assert by_id["11"]["schedule_class"] == "blocked" and by_id["15"]["schedule_class"] == "overdue"
    assert not by_id["13"]["has_end_date"] and by_id["18"]["days"] is None


def test_open_hierarchy_loses_children_of_completed_parents(erp):
    t = plan(erp)
    rows = projects.project_hierarchy(t, DAY, only_open=True).orderBy(*projects.hierarchy_order()).collect()
    assert [r["id"] for r in rows] == ["P1", "10", "11", "18", "13", "P2"]
    lost = {r["project_id"]: r["orphan_count"] for r in projects.hierarchy_orphans(projects.plan_tasks(t), only_open=True).collect()}
    assert lost == {1: 1, 2: 2}


# --- search ----------------------------------------------------------------------------------

def python_terms(query, limit, translations, rules, stop):
    terms = []
    for word in query.lower().split():
        if word not in stop and len(word) > 2:
            terms.append(word)
            other = translations.get(word)
            if other and other not in terms:
                terms.append(other)
    for triggers, extra in rules:
        if any(t in query.lower() for t in triggers):
            for term in extra:
                if term not in terms:
                    terms.append(term)
    return terms[:limit]


def test_terms_agree_with_a_loop(spark):
    rng = random.Random(1)
    words = ["torre", "3", "cronograma", "schedule", "de", "the", "hidráulico", "water", "planos", "plans", "ab", "Tower", "project"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(60)] + ["  Torre   3  "]
    df = spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")
    out = {}
    for r in search.search_terms(df, 7).orderBy("query_id", "term_rank").collect():
        out.setdefault(r["query_id"], []).append(r["term"])
    for i, query in enumerate(texts):
        assert out.get(i, []) == python_terms(query, 7, ref.TRANSLATIONS, ref.TERM_RULES, ref.STOP_WORDS), query


def test_messages_agree_with_a_loop(spark):
    rng = random.Random(5)
    boxes = ["a@x", "b@x", "noreply@x", "c@x", "System@x"]
    rows = [(f"m{i}", "a@x" if i % 3 == 0 else rng.choice(boxes), f"s{i % 4}", "Alpha" if i % 2 else "beta",
             rng.choice(["gamma ray", "alpha", "delta", "BETA gamma"]), DAY - dt.timedelta(days=rng.randrange(120))) for i in range(300)]
    messages = spark.createDataFrame(rows, "id string, mailbox string, sender string, subject string, body string, received date")
    preset = SearchPreset(max_terms=3, max_mailboxes=3, days_back=90, per_term=4)
    queries = spark.createDataFrame([("q1", "alpha gamma"), ("q2", "zeta")], "query_id string, query string")
    terms = search.search_terms(queries, preset.max_terms)
    chosen = search.mailboxes(messages, ["z@x", "b@x"], preset.max_mailboxes)
    order = [r["mailbox"] for r in chosen.orderBy(*search.mailbox_order()).collect()]
    assert order == ["z@x", "b@x", "a@x"]
    got = search.find_messages(messages, terms, chosen, preset, DAY)
    floor, seen = DAY - dt.timedelta(days=90), {}
    for box in order:
        for term in ("alpha", "gamma"):
            hits = [r for r in rows if r[1] == box and r[5] >= floor and term in f"{r[3]} {r[4]}".lower()]
            for r in sorted(hits, key=lambda r: (-r[5].toordinal(), r[0]))[:4]:
                seen.setdefault(r[0], term)
    assert {r["id"]: r["matched_term"] for r in got.collect()} == seen and len(seen) > 8
    digest = search.search_digest(got).collect()
    assert [(r["query_id"], r["messages"]) for r in digest] == [("q1", len(seen))]
    assert not SEARCH_PRESETS["DEEP"].has_date_floor


# --- quality ---------------------------------------------------------------------------------

def test_health(spark):
    now = dt.datetime(2024, 1, 2, 12)
    files = spark.createDataFrame(
        [("a_20240101_0101.csv", now - dt.timedelta(hours=30), 10), ("a_20240102_0101.csv", now - dt.timedelta(hours=1), 2048),
         ("b.csv", now - dt.timedelta(hours=27), 1), ("c.csv", now - dt.timedelta(hours=2), 1)],
        "file_name string, mtime timestamp_ntz, size_bytes bigint")
    expected = spark.createDataFrame([("A", "a.csv"), ("B", "b.csv"), ("C", "c.csv"), ("C", "c2.csv"), ("D", "d.csv")],
                                     "dataset string, output string")
    outputs = quality.output_status(expected, files, now)
    health = quality.dataset_health(outputs)
    assert {r["dataset"]: r["status"] for r in health.collect()} == {"A": "ok", "B": "stale", "C": "partial", "D": "missing"}
    assert outputs.filter("output = 'a.csv'").first()["size_kb"] == 2.0
    assert quality.health_overall(health).first()["status"] == "degraded"
    assert quality.health_overall(health.filter("status = 'ok'")).first()["status"] == "healthy"
    assert quality.health_overall(health.filter("status <> 'ok'")).first()["status"] == "down"


def test_log_errors(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(f"f{f}.log", start + dt.timedelta(hours=f), n, f"  line {n} " + ("Traceback " + "x" * 300 if n % 2 else "fine"))
            for f in range(7) for n in range(4)]
    lines = spark.createDataFrame(rows, "file_name string, mtime timestamp_ntz, line_no bigint, value string")
    out = quality.log_errors(lines, limit=8).collect()
    assert [(r["file_name"], r["line_no"]) for r in out] == [(f"f{f}.log", n) for f in (6, 5, 4, 3) for n in (1, 3)]
    assert all(len(r["message"]) == 200 for r in out)
    assert quality.log_errors(lines, since=start + dt.timedelta(hours=6)).count() == 2


def test_run_summary(spark):
    runs = spark.createDataFrame([("a", "success", 1.5), ("b", "failed", 2.0)], "job string, status string, duration_seconds double")
    files = spark.createDataFrame([("stock_cash.csv",), ("Inventory.csv",), ("asistencia.csv",)], "file_name string").select(
        "file_name", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("mtime"), F.lit(1).cast("bigint").alias("size_bytes"))
    row = quality.run_summary(runs, quality.latest_files(files)).first()
    assert (row["success_count"], row["failure_count"], row["total_duration_seconds"]) == (1, 1, 3.5)
    assert (row["stock_reports"], row["cash_flow_reports"], row["inventory_reports"], row["attendance_reports"], row["total_files"]) == (1, 1, 1, 1, 3)
    assert [r["job"] for r in quality.failed_jobs(runs).collect()] == ["b"]


def test_order_texts_are_joined_after_the_other_shuffles_of_the_lines(spark):
    """The join with the orders is the last of the order lines: no shuffle of lines carries the texts of an order."""
    from checks.queries import order_lines
    from checks.views import erp

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = order_lines(erp(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert "order_id" in joins[0] and any("line_id" in line for line in joins[1:])


def test_wide_moves_are_not_shuffled_by_cost(spark):
    """The cost comes with the product; order texts meet only lines that moves name."""
    from checks.views import erp
    from ledgerloom.plans import stock

    t, limit = erp(spark, "/root/testdata/sf0.001"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = stock.stock_movements(t)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = stock.stock_movements(t)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_product#" not in plan
        assert "hashpartitioning(bought_header#" in plan and "hashpartitioning(sold_header#" in plan
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_index_rows_are_not_shuffled(spark):
    """The matching words go to the index rows; where these are too many, both meet by the word, with the same hits."""
    rows = spark.createDataFrame([(f"m{i}", f"alpha w{i} {'betaville' if i % 3 else 'x'} end") for i in range(60)], "id string, text string")
    terms = spark.createDataFrame([("beta",), ("w1",), ("ville end",)], "term string")
    limit, found = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    try:
        for most in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            hits = search.term_hits(rows, F.col("text"), terms)
            found.append(sorted(map(tuple, hits.collect())))
            moved = "hashpartitioning(word" in hits._jdf.queryExecution().sparkPlan().toString() or "RepartitionByExpression" in hits._jdf.queryExecution().optimizedPlan().toString()
            assert not moved
            assert ("BroadcastHashJoin [word" in hits._jdf.queryExecution().sparkPlan().toString()) == (most == "10m")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = [(f"m{i}", term) for i in range(60) for term in ("beta", "w1", "ville end")
            if term in f"alpha w{i} {'betaville' if i % 3 else 'x'} end"]
    assert found == [sorted(want)] * 2


def test_bills_meet_their_orders_once(spark):
    """The orders of the bills are settled: the list and its number do not join the lines again."""
    from checks.views import erp

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = payables.bills(erp(spark, "/root/testdata/sf0.001"), DAY)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "purchase_line_id" not in plan


def test_only_lines_invoiced_in_full_meet_bills(erp):
    """What is open of other lines does not depend on bills: they are summed by order, with no shuffle by their id."""
    def line(id, order_id, qty, invoiced):
        return dict(id=id, order_id=order_id, product_qty=qty and D(qty), qty_invoiced=invoiced and D(invoiced), price_unit=D(3), price_total=D(10))

    t = erp(
        purchase_order_line=[line(1, 1, 2, None), line(2, 1, 2, 1), line(3, 1, 2, 2), line(4, 2, None, 2), line(5, 2, 2, 2), line(5, 2, 2, 2),
                             line(None, 3, 2, 2), line(7, 4, None, None), line(8, None, 2, 2), dict(id=9, order_id=5)],
        account_move=[dict(id=m, move_type="in_invoice", state="posted", payment_state="not_paid", amount_residual_signed=D(a)) for m, a in ((1, -70), (2, 40))],
        account_move_line=[dict(id=n, move_id=m, purchase_line_id=p) for n, (m, p) in enumerate([(1, 1), (1, 2), (1, 3), (2, 3), (2, 4), (2, 5), (1, 8)])])
    pending = projects.order_pending(t)
    plan = pending._jdf.queryExecution().optimizedPlan().toString()
    assert {r["order_id"]: r["pending"] for r in pending.collect()} == {
        1: D(10 + 3 + 70), 2: D(40 + 40 + 40), 3: D(0), 4: D(10), None: D(70), 5: None}
    joins = plan[plan.index("Join LeftOuter"):]
    assert "price_total" not in joins[:joins.index("LogicalRDD")] and "Union" in plan


ORDER_LINES = dict(
    res_partner=[dict(id=1, name="P1"), dict(id=2, name="P2")], res_users=[dict(id=5, partner_id=2)], res_currency=[dict(id=2, name="USD")],
    product_product=[dict(id=7, product_tmpl_id=70, default_code="S")], product_template=[dict(id=70, name="N")],
    purchase_order=[dict(id=i, name=f"O{i}", state="purchase", partner_id=1, user_id=5 if i == 1 else None) for i in (1, 1, 2)],
    purchase_order_line=[dict(id=k, order_id=o, product_id=7, name=f"l{k}", product_qty=D(4), qty_received=D(r), qty_invoiced=D(0),
                              price_unit=D(1), price_total=D(4)) for k, o, r in ((11, 1, 4), (11, 1, 0), (11, 2, 0), (12, 2, 1), (None, 2, 0))],
    account_move=[dict(id=m, name=f"B{m}", move_type="in_invoice", state="posted", payment_state="partial", amount_residual_signed=D(m))
                  for m in (31, 32, 32)],
    account_move_line=[dict(id=n, move_id=m, purchase_line_id=k) for n, (m, k) in enumerate(((31, 11), (31, 11), (32, 11), (32, None), (31, 99)))])


def test_order_lines_are_shuffled_once(erp, spark):
    """Bills and products come to the lines, which are shuffled by their order alone; keys may repeat or be missing."""
    from test_operators import shuffled_with

    from ledgerloom.plans import purchasing

    t, limit = erp(**ORDER_LINES), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = purchasing.po_lines(t, DAY)
        assert shuffled_with(lines._jdf.queryExecution().executedPlan(), "line_description") \
            + shuffled_with(lines._jdf.queryExecution().executedPlan(), "qty_received") == 2  # the one shuffle holds both
        rows = sorted((r["po_number"], r["line_id"] or 0, r["invoice_count"], r["invoice_number"], r["invoice_unpaid"], r["buyer_name"])
                      for r in lines.collect())
        assert rows == sorted([("O1", 11, 2, "B31", D(63), "P2")] * 4 + [("O2", 11, 2, "B31", D(63), "")]
                              + [("O2", k, 0, "", D(0), "") for k in (0, 12)], key=lambda r: r[:2])
        waiting = purchasing.po_lines(t, DAY, only_waiting=True)
        assert waiting.exceptAll(lines.filter("qty_pending_receipt > 0")).isEmpty() and waiting.count() == 5
        bills = sorted((r["po_number"], r["invoice_number"]) for r in purchasing.po_lines(t, DAY, per_invoice=True).filter("line_id = 11").collect())
        assert bills == [("O1", "B31")] * 4 + [("O1", "B32")] * 4 + [("O2", "B31"), ("O2", "B32")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_wide_moves_stay_by_their_id(spark):
    """Employees come with the creator of a move: after the shuffle by the move no other follows, and lots are shuffled once."""
    from checks.views import erp
    from ledgerloom.plans import stock
    from test_operators import shuffled_with

    t, limit = erp(spark, "/root/testdata/sf0.001"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stock.stock_movements(t)._jdf.queryExecution().executedPlan()
        assert shuffled_with(plan, "location_dest_id") == 7  # by product, two places, unit, the move, two warehouses
        assert plan.toString().count("hashpartitioning(_creator#") == 0 and plan.toString().count("hashpartitioning(move_id#") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_bill_lines_are_shuffled_once(erp, spark):
    """Products come to the lines of a bill; lines without a product, and bills without lines, stay."""
    from test_operators import shuffled_with

    t = erp(res_partner=[dict(id=1, name="P1")], product_product=[dict(id=7, product_tmpl_id=70, default_code="S")] * 2,
            product_template=[dict(id=70, name="N")],
            account_move=[dict(id=m, name=f"B{m}", move_type="in_invoice", state="posted", partner_id=1) for m in (31, 32)],
            account_move_line=[dict(id=n, move_id=m, product_id=p, name=f"l{n}") for n, (m, p) in enumerate(
                ((31, 7), (31, 7), (31, None), (31, 8), (None, 7)))])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = payables.vendor_bills(t, payables.bills(t, DAY))
        assert shuffled_with(lines._jdf.queryExecution().executedPlan(), "price_subtotal") == 1
        rows = sorted((r["bill_id"], r["line_id"] if r["line_id"] is not None else -1, r["product_name"]) for r in lines.collect())
        assert rows == [(31, 0, "N"), (31, 0, "N"), (31, 1, "N"), (31, 1, "N"), (31, 2, ""), (31, 3, ""), (32, -1, "")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
