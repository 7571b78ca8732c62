"""The registered queries: every mart over the test tables, with settled output types."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import params, session
from ledgerloom.functions import dates, money, status, text
from ledgerloom.operators import explore, groups, joins, ordered
from ledgerloom.plans import attendance, cash, inventory, payables, projects, purchasing, quality, search, stock
from ledgerloom.shared import shared_folder
from ledgerloom.sinks import reports, runs
from ledgerloom.sources import files, layout, loose
from ledgerloom.sources.sizes import fits
from ledgerloom.sources.tables import query as sql_query

from .views import erp, source

DAY = dt.date(1998, 6, 15)
SITE = params.AsOf(dt.date(2024, 1, 15), dt.datetime(2024, 1, 16, 6, 0))
MAIL_DAY = dt.date(2024, 6, 30)
WEEK_END = params.AsOf(dt.date(2024, 1, 14), dt.datetime(2024, 1, 15, 6, 0))
LOG_TIME = dt.datetime(2024, 1, 31, 1, 0)

# A dictionary and rules that fire on the texts of `benchmark`, which are the queries of the search.
SEARCH_WORDS = {"hein": "thre", "sich": "eaux", "pour": "ouen"}
SEARCH_RULES = ((("therble", "eaux"), ("ung", "plumbing")), (("that thi",), ("ther", "eaux")))
PRIORITY = ("src3@example.com", "user@example.com", "ghost@example.com")

EXPECTED_OUTPUTS = (
    ("clicks", "click_report.csv"), ("clicks", "click_detail.csv"), ("views", "view_report.csv"),
    ("signups", "signup_report.csv"), ("purchases", "purchase_report.csv"), ("payroll", "payroll_report.csv"),
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def edge(df: DataFrame) -> DataFrame:
    """Settle output types: amounts as double, dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(build):
    """Register ``build(tables)`` or ``build(tables, spark, folder)`` under its own name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        session.tune(spark)
        tables = erp(spark, folder)
        wants = build.__code__.co_argcount
        return edge(build(*(tables, spark, folder)[:wants]))

    REGISTRY[build.__name__] = run
    return build


def listed(parts: DataFrame, text=lambda v: v) -> DataFrame:
    """Parts of lists with their values as one text."""
    return parts.withColumn("values", F.array_join(F.transform("values", text), "; "))


# --- inventory -------------------------------------------------------------------------------

@register
def inventory_position(t):
    return inventory.inventory_position(t)


@register
def inventory_totals(t):
    return inventory.inventory_totals(inventory.inventory_position(t))


def stock_sheet(t, spark, folder):
    """Quantities per product with a reorder range, as an inventory sheet carries them."""
    part = source(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size") * 10).otherwise(0).cast("decimal(18,4)").alias("reorder_point"),
        (F.col("p_size") * 20).cast("decimal(18,4)").alias("reorder_max"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_cost"))
    held = t["stock_quant"].groupBy("product_id").agg(F.sum("quantity").alias("qty_on_hand"))
    moves = t["stock_move"].filter("state = 'assigned'").groupBy("product_id").agg(
        F.sum("product_uom_qty").alias("qty_reserved"))
    df = part.join(held, "product_id", "left").join(moves, "product_id", "left")
    names = t["product_template"].select(F.col("id").alias("product_id"), text.localized("name").alias("product"))
    return df.na.fill(0, ["qty_on_hand", "qty_reserved"]).join(names, "product_id")


@register
def inventory_levels(t, spark, folder):
    return inventory.inventory_levels(stock_sheet(t, spark, folder))


@register
def inventory_alerts(t, spark, folder):
    levels = inventory.inventory_levels(stock_sheet(t, spark, folder))
    return inventory.inventory_alerts(levels, "product_id").select("product_id", "product", "level", "qty_available", "alert_rank")


@register
def level_distribution(t, spark, folder):
    return inventory.level_distribution(inventory.inventory_levels(stock_sheet(t, spark, folder)))


@register
def inventory_kpis(t, spark, folder):
    return inventory.inventory_kpis(inventory.inventory_levels(stock_sheet(t, spark, folder)))


@register
def inventory_top_categories(t, spark, folder):
    levels = inventory.inventory_levels(stock_sheet(t, spark, folder))
    return groups.top_groups(levels, "category", "total_value", blank="(sin categoría)")


# --- stock movements -------------------------------------------------------------------------

@register
def stock_movements(t):
    return stock.stock_movements(t).drop("transaction_summary")


@register
def stock_sentence(t):
    return stock.stock_movements(t).select("movement_id", "lot_serial_name", "task_name", "warehouse", "transaction_summary")


@register
def stock_movements_all_locations(t):
    fact = stock.stock_movements(t, locations=None)
    return fact.groupBy("movement_type", "partner_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_value").alias("total_value"))


@register
def stock_or_join(t):
    moves = t["stock_move"].select("id", "location_id", "location_dest_id")
    for fk, name in (("location_id", "src_warehouse"), ("location_dest_id", "dst_warehouse")):
        moves = joins.look_up(moves, t["stock_location"], fk, name, {"warehouse_id": name}, small=fits(t, "stock_location"))
    return joins.either_key_join(moves, t["stock_warehouse"], "src_warehouse", "dst_warehouse",
                                 {"id": "warehouse_id", "name": "warehouse"})


@register
def stock_by_type(t):
    return stock.stock_by_type(stock.move_values(t))


@register
def stock_by_type_all_rows(t):
    return stock.stock_by_type(stock.stock_movements(t))


@register
def stock_by_type_first_rows(t):
    return stock.stock_by_type(stock.first_rows(stock.stock_movements(t)))


@register
def stock_by_category(t):
    return stock.stock_by_category(stock.move_values(t))


@register
def stock_by_purpose(t):
    return stock.stock_by_purpose(stock.move_values(t))


@register
def stock_by_month(t):
    return stock.stock_by_month(stock.move_values(t))


@register
def stock_kpis(t):
    return stock.stock_kpis(stock.move_documents(t))


@register
def fan_out_check(t):
    moves = t["stock_move"].select("id")
    lots = t["stock_move_line"].select(F.col("move_id").alias("id"), "lot_id")
    return joins.fan_out(moves, moves.join(lots, "id", "left"), "id")


@register
def row_expectation(t, spark, folder):
    """The extract is written once; what goes in and what comes out is counted in that pass."""
    moves, expected = quality.counted(stock.main_location_moves(t["stock_move"]))
    run = runs.write_run(stock.stock_movements(t, moves=moves), new_folder(spark, "extract"), DAY)
    return quality.row_expectation(spark, expected.get["rows"], run.rows)


# --- cash flow -------------------------------------------------------------------------------

@register
def cash_requirements(t):
    return cash.cash_requirements(t).withColumn("notes", text.html_to_lines(F.col("notes"), text.decode_common_entities))


@register
def cash_requirements_even(t):
    return cash.cash_requirements(t, allocate="even").select("po_id", "task_id", "amount_pending", "amount_gtq")


@register
def cash_requirements_per_line(t):
    return cash.cash_requirements(t, per_line=True).select("po_id", "task_id", "amount_pending")


@register
def weekly_cash_flow(t):
    return cash.weekly_cash_flow(cash.cash_requirements(t), DAY)


@register
def weekly_cash_flow_as_reported(t):
    return cash.weekly_cash_flow(cash.cash_requirements(t), DAY, mode="as_reported")


@register
def weekly_cash_flow_with_overdue(t):
    return cash.weekly_cash_flow(cash.cash_requirements(t), DAY, overdue=True)


@register
def cash_totals(t):
    return cash.cash_totals(cash.weekly_cash_flow(cash.cash_requirements(t), DAY))


@register
def cash_project_pivot(t):
    return cash.cash_project_pivot(cash.cash_requirements(t), DAY)


@register
def cash_top_projects(t):
    return cash.cash_top_projects(cash.cash_requirements(t), DAY)


@register
def cash_document(t):
    """The nested document, its parts written out so that SQL can state them."""
    needs = cash.cash_requirements(t)
    document = cash.cash_document(cash.weekly_cash_flow(needs, DAY), cash.cash_top_projects(needs, DAY))
    projects_ = F.transform("top_projects", lambda p: F.concat_ws(": ", p["project"], p["amount"].cast("decimal(38,2)").cast("string")))
    return document.select("week_start", "week_end", "label", "total_gtq", "total_usd", "count", "by_status.*",
                           F.array_join(projects_, "; ").alias("top_projects"))


@register
def cash_list(t):
    needs = cash.cash_requirements(t).select("payment_date", "po_number", "po_id", "task_id", F.lit("").alias("notes"))
    return cash.cash_detail(needs).drop("notes")


# --- purchasing ------------------------------------------------------------------------------

def order_lines(t, **options):
    return purchasing.po_lines(t, DAY, decode=text.decode_common_entities, **options)


@register
def po_lines(t):
    return order_lines(t)


@register
def po_lines_bucketed(t, spark, folder):
    """The order lines over tables that are bucketed by order and by bill."""
    names = layout.write_bucketed(t, new_folder(spark, "layout"), layout.bucket_count(t, 8))
    return order_lines(layout.bucketed_tables(spark, t, names))


@register
def po_lines_per_invoice(t):
    return order_lines(t, per_invoice=True, null_received_is_zero=False).select(
        "line_id", "invoice_number", "amount_pending", "reception_status", "payment_status", "days_overdue")


@register
def open_po_summary(t):
    return purchasing.open_po_summary(order_lines(t))


@register
def open_po_summary_as_reported(t):
    return purchasing.open_po_summary(order_lines(t), mode="as_reported")


@register
def pending_receipts(t):
    return purchasing.pending_receipts(order_lines(t, only_waiting=True))


@register
def done_po_summary(t):
    return purchasing.done_po_summary(order_lines(t))


@register
def po_state_split(t):
    parts = purchasing.split_states(order_lines(t))
    counts = [df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("lines")) for name, df in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register
def po_pending_by_currency(t):
    return purchasing.po_pending_by_currency(order_lines(t))


@register
def po_stats(t):
    return purchasing.po_stats(order_lines(t))


# --- vendor bills ----------------------------------------------------------------------------

def bill_headers(t, **options):
    return payables.bills(t, DAY, decode=text.decode_common_entities, **options)


@register
def vendor_bills(t):
    return payables.vendor_bills(t, bill_headers(t))


@register
def bill_orders(t):
    return payables.bill_orders(t)


@register
def bill_order_parts(t):
    return listed(payables.bill_order_parts(t))


@register
def bills_with_drafts(t):
    return bill_headers(t, only_posted=False, sign="abs", orders=False).groupBy("bill_state", "currency").agg(
        F.count(F.lit(1)).alias("bills"), F.sum("bill_residual_signed").alias("residual"))


@register
def bills_next_7(t):
    return payables.bills_next_days(bill_headers(t), DAY)


@register
def bills_unpaid(t):
    return payables.bills_unpaid(bill_headers(t))


@register
def bills_paid(t):
    return payables.bills_paid(bill_headers(t))


@register
def bill_list(t):
    lines = payables.vendor_bills(t, bill_headers(t))
    return payables.bill_list(lines.select("bill_id", "line_id", "effective_due_date", "invoice_date", "sequence")).drop("sequence")


@register
def bill_lines(t):
    return payables.bill_lines(payables.vendor_bills(t, bill_headers(t)))


@register
def bill_stats(t):
    return payables.bill_stats(bill_headers(t, orders=False))


@register
def bills_pending_by_currency(t):
    return payables.bills_pending_by_currency(bill_headers(t, orders=False))


# --- projects --------------------------------------------------------------------------------

@register
def project_tasks(t):
    return projects.project_tasks(t)


@register
def plan_list(t):
    tasks = projects.plan_tasks(t).select("task_id", "parent_id", "project_name", "sequence")
    return projects.plan_list(tasks).drop("sequence")


@register
def task_dependencies(t):
    return projects.task_dependencies(t)


@register
def task_po_pending(t):
    return projects.task_po_pending(projects.task_orders(t))


@register
def task_people_parts(t):
    return listed(projects.task_people_parts(t))


@register
def task_reference_parts(t):
    return listed(projects.task_reference_parts(t))


@register
def project_reference_parts(t):
    return listed(projects.project_reference_parts(t))


@register
def project_hierarchy(t):
    return projects.project_hierarchy(t, DAY)


@register
def open_project_hierarchy(t):
    return projects.project_hierarchy(t, DAY, only_open=True, now=dt.datetime(1998, 6, 15, 9, 30))


@register
def hierarchy_orphans(t):
    return projects.hierarchy_orphans(projects.plan_tasks(t), only_open=True)


@register
def gantt_rows(t):
    return projects.gantt_rows(projects.project_tasks(t))


@register
def project_summary(t):
    return projects.project_summary(t)


@register
def project_summary_total(t):
    return projects.project_summary_total(projects.project_summary(t)).withColumn(
        "avg_progress", F.round("avg_progress", 6))


@register
def project_order_refs(t):
    return projects.project_order_refs(projects.plan_tasks(t), projects.task_orders(t))


@register
def task_reference_list(t):
    rows = projects.explode_list(projects.task_po_pending(projects.task_orders(t)), "po_references", "po_reference")
    return rows.groupBy("po_reference").agg(F.count(F.lit(1)).alias("tasks"))


@register
def plan_stats(t):
    return projects.plan_stats(t, DAY)


# --- attendance ------------------------------------------------------------------------------

@register
def site_roster(t):
    return attendance.site_roster(t)


@register
def on_site_now(t):
    return attendance.on_site_now(t, SITE)


@register
def site_status(t):
    return attendance.site_status(attendance.on_site_now(t, SITE), SITE)


@register
def daily_movements(t):
    return attendance.daily_movements(t, SITE)


@register
def week_attendance(t):
    return attendance.period_attendance(t, WEEK_END, *attendance.week_range(WEEK_END)).drop("worked_micros")


@register
def period_attendance(t):
    return attendance.period_attendance(t, SITE, dt.date(2024, 1, 1), SITE.date).drop("worked_micros")


@register
def week_overtime(t):
    return attendance.week_overtime(attendance.period_attendance(t, WEEK_END, dt.date(2024, 1, 1), WEEK_END.date))


@register
def attendance_sessions(t):
    return attendance.attendance_sessions(t, SITE)


@register
def attendance_sessions_all_gaps(t):
    return attendance.attendance_sessions(t, SITE, breaks=params.BreakRule.every_gap(), open_hours="ignore",
                                          departments=("Obra", "Bodega", "Ventas"))


@register
def attendance_sessions_replaced(t):
    return attendance.attendance_sessions(t, SITE, open_hours="replace").select("work_date", "employee_id", "total_hours")


@register
def attendance_json(t):
    """The nested document, its records written out so that SQL can state them."""
    records = F.transform("clock_records", lambda e: F.concat_ws(" ", e["type"], e["time"]))
    return attendance.attendance_days(t, SITE).withColumn("clock_records", F.array_join(records, "; "))


@register
def clock_record_parts(t):
    return listed(attendance.clock_record_parts(t, SITE), lambda e: F.concat_ws(" ", e["type"], e["time"]))


@register
def attendance_clock_records(t):
    return attendance.clock_records(t, SITE).select(
        "work_date", "employee_id", F.col("event.type").alias("type"), F.col("event.time").alias("time"),
        F.col("event.id").alias("record_id"))


@register
def attendance_daily(t):
    return attendance.attendance_daily(attendance.attendance_sessions(t, SITE))


@register
def attendance_span(t):
    return attendance.attendance_span(t, SITE)


@register
def parameterised_scan(t, spark, folder):
    sql = """SELECT e.id AS employee_id, d.name AS department_name
             FROM {employees} e JOIN {departments} d ON e.department_id = d.id
             WHERE e.active AND array_contains(:departments, d.name) AND e.id >= :lowest"""
    return sql_query(spark, sql, {"employees": t["hr_employee"], "departments": t["hr_department"]},
                     departments=["Obra", "Bodega"], lowest=2)


# --- message search --------------------------------------------------------------------------

def search_input(spark, folder, mode):
    """The terms of every benchmark text, as many as the depth of the mode allows."""
    queries = source(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.search_terms(queries, params.SEARCH_PRESETS[mode].max_terms, translations=SEARCH_WORDS, rules=SEARCH_RULES)


def searched(t, spark, folder, mode="NORMAL"):
    preset = params.SEARCH_PRESETS[mode]
    boxes = search.mailboxes(t["messages"], PRIORITY, preset.max_mailboxes)
    return search.find_messages(t["messages"], search_input(spark, folder, mode), boxes, preset, MAIL_DAY)


@register
def search_terms(t, spark, folder):
    return search_input(spark, folder, "NORMAL")


@register
def search_terms_fast(t, spark, folder):
    return search_input(spark, folder, "FAST")


@register
def search_terms_deep(t, spark, folder):
    return search_input(spark, folder, "DEEP")


@register
def mailboxes(t):
    return search.mailboxes(t["messages"], PRIORITY, 15)


@register
def message_search(t, spark, folder):
    return search.message_search(searched(t, spark, folder))


@register
def message_search_fast(t, spark, folder):
    return searched(t, spark, folder, "FAST")


@register
def message_search_deep(t, spark, folder):
    return searched(t, spark, folder, "DEEP")


@register
def search_digest(t, spark, folder):
    return search.search_digest(searched(t, spark, folder))


@register
def recent_messages(t, spark, folder):
    return search.recent_messages(searched(t, spark, folder))


# --- text ------------------------------------------------------------------------------------

@register
def clean_html_notes(t, spark, folder):
    pages = source(spark, folder, "pages")
    return pages.select("page_id", text.html_to_lines(F.col("html"), text.decode_common_entities).alias("plain"))


@register
def clean_html_all_entities(t, spark, folder):
    return source(spark, folder, "pages").select("page_id", text.html_to_lines(F.col("html")).alias("plain"))


@register
def clean_html_desc(t, spark, folder):
    return source(spark, folder, "pages").select("page_id", text.html_to_summary(F.col("html")).alias("summary"))


@register
def clean_text_strict(t, spark, folder):
    return source(spark, folder, "documents").select("doc_id", text.strip_control(F.col("text")).alias("clean"))


@register
def clean_text_keep_lines(t, spark, folder):
    return source(spark, folder, "documents").select(
        "doc_id", text.strip_control(F.col("text"), "keep_layout").alias("clean"),
        text.strip_control(F.col("text"), "one_line").alias("one_line"))


@register
def clean_text_squash(t, spark, folder):
    return source(spark, folder, "documents").select("doc_id", text.squash_lines(F.col("text")).alias("clean"))


@register
def clean_every_text_column(t):
    return text.map_text(t["purchase_order_line"].select("id", "order_id", "name"), text.squash_lines)


@register
def localized_name(t):
    c = F.col("name")
    return t["product_template"].select(
        "id", text.localized(c).alias("name"), text.localized_only(c).alias("strict"),
        text.localized_nonblank(c).alias("nonblank"))


@register
def json_props(t, spark, folder):
    key = F.get_json_object("props", "$.k").cast("int")
    return source(spark, folder, "events").groupBy(key.alias("k"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@register
def format_labels(t):
    amount = F.col("amount_total")
    return t["purchase_order"].select(
        "id", money.money_label(amount).alias("money"), text.thousands_label(amount).alias("compact"),
        text.file_size_label(F.floor(amount * 7).cast("bigint")).alias("size"),
        dates.display_date(F.col("date_order")).alias("shown"),
        dates.iso_prefix(F.col("date_order").cast("string")).alias("iso"),
        text.label_of(F.lower("state"), {k: v for k, v in text.ref.VIEWER_STATE_LABELS.items()}).alias("label"),
        text.erp_link("https://erp.example.com/web#", F.concat(F.lit("P"), F.col("id").cast("string")), project=True).alias("link"),
        dates.days_overdue(F.col("date_planned"), DAY).alias("days_overdue"),
        dates.days_until(F.col("date_planned"), DAY).alias("days_until"),
        dates.days_until_floor(F.col("date_planned"), dt.datetime(1998, 6, 15, 8, 0)).alias("days_until_floor"),
        status.is_overdue(dates.days_until(F.col("date_planned"), DAY), F.col("state") == "done").alias("overdue"))


# --- explorers -------------------------------------------------------------------------------

def order_list(t):
    partners = t["res_partner"].select(F.col("id").alias("partner_id"), F.col("name").alias("vendor"))
    return t["purchase_order"].join(partners, "partner_id").select(
        "id", F.col("name").alias("po_name"), "vendor", F.col("partner_ref").alias("partner"), "date_order",
        F.col("state").alias("status"), F.col("amount_total").alias("total_amount"),
        (F.col("id") % 101).cast("double").alias("received_pct"))


def explored(t):
    df = explore.facet(order_list(t), {"status": "purchase", "vendor": "", ("vendor", "partner"): None})
    df = explore.between_days(df, "date_order", dt.date(1996, 1, 1), dt.date(1999, 12, 31))
    return explore.search(df, "ER#00", ["po_name", "vendor", "status", "date_order"])


@register
def explore_page(t):
    return explore.page(explored(t), ["-total_amount", "id"], 3, 50)


@register
def explore_page_by_vendor(t):
    return explore.page(explored(t), ["vendor", "-date_order", "id"], 2, 50)


@register
def explore_page_by_partner(t):
    """A deep page of all orders by a column with gaps."""
    return explore.page(order_list(t), ["-partner", "status", "id"], 20, 50)


@register
def explore_deep_page(t):
    """Row numbers of all orders, newest first."""
    df = order_list(t).select("id", "date_order", "total_amount")
    return ordered.numbered(df, [F.desc("date_order"), F.desc("id")])


@register
def explore_either_facet(t):
    return explore.facet(order_list(t), {("vendor", "partner"): "REF-7"})


@register
def explore_facets(t):
    return explore.facet_values(order_list(t), "partner")


@register
def explore_kpis(t):
    df = explored(t)
    confirmed = F.col("status").isin("purchase", "done")
    text_date = F.nullif(F.col("date_order").cast("string"), F.lit(""))
    grouped = df.groupBy("vendor").agg(  # vendors are counted over groups
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("total_amount"),
        F.count_if(confirmed).alias("confirmed"), F.sum(F.when(confirmed, F.col("total_amount"))).alias("confirmed_amount"),
        F.count_if(F.col("status").isin("draft", "sent")).alias("pending"),
        F.sum(F.coalesce("received_pct", F.lit(0.0))).alias("received"),
        F.min(text_date).alias("first_date"), F.max(text_date).alias("last_date"))
    sums = ("orders", "total_amount", "confirmed", "confirmed_amount", "pending")
    return grouped.agg(*[F.sum(c).alias(c) for c in sums], (F.sum("received") / F.sum("orders")).alias("avg_received"),
                       F.count("vendor").alias("vendors"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


@register
def top_groups(t):
    return groups.top_groups(order_list(t), "partner", "total_amount")


@register
def group_counts(t):
    return groups.labelled_groups(order_list(t), "status", "total_amount")


@register
def viewer_kpis(t):
    """Moves are summed per product first, so names are counted over groups."""
    by, value = F.col("movement_type"), F.col("total_value")
    grouped = stock.move_values(t).groupBy("product_name").agg(
        F.count(F.lit(1)).alias("movements"), F.sum(value).alias("total_value"),
        F.count_if(by == "Stock In").alias("stock_in"), F.sum(F.when(by == "Stock In", value)).alias("in_value"),
        F.count_if(by == "Stock Out").alias("stock_out"), F.sum(F.when(by == "Stock Out", value)).alias("out_value"),
        F.min("movement_date").alias("first_date"), F.max("movement_date").alias("last_date"))
    sums = ("movements", "total_value", "stock_in", "in_value", "stock_out", "out_value")
    return grouped.agg(*[F.sum(c).alias(c) for c in sums], F.count("product_name").alias("products"),
                       F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


@register
def products_by_period(t):
    names = t["product_template"].select(text.localized("name").alias("product_name"))
    return stock.products_by_period(stock.move_values(t), names)


@register
def loose_headers(t, spark, folder):
    raw = source(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order Reference"),
        F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("Vendor"),
        F.col("o_orderstatus").alias("Partner / Name"), F.col("o_orderstatus").alias("Partner"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("Date Order"),
        F.when(F.col("o_orderkey") % 5 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("Total (Amount)"),
        F.col("o_totalprice").alias("Total"), F.concat(F.col("o_custkey").cast("string"), F.lit("%")).alias("Received"))
    return loose.order_sheet(raw.withColumnRenamed("Total (Amount)", "Total Amount"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the one that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_csv(df: DataFrame, name: str) -> str:
    """A CSV file set of a table."""
    path = new_folder(df.sparkSession, name)
    reports.write_csv(df, path)
    return path


@register
def latest_report(t, spark, folder):
    """Two dated runs and one of an earlier date written after them; the latest date is read by its record."""
    path = new_folder(spark, "orders-report")
    for day in (dt.date(1996, 6, 30), dt.date(1998, 6, 30), dt.date(1994, 6, 30)):
        orders = t["purchase_order"].filter(F.col("date_order") <= F.lit(day))
        runs.write_run(orders.groupBy("state").agg(F.count(F.lit(1)).alias("orders"), F.sum("amount_total").alias("amount")), path, day)
    return runs.read_run(spark, path).withColumn("run_rows", F.lit(runs.published(spark, path).rows).cast("bigint"))


@register
def report_sections(t, spark, folder):
    """A report of two sections written as JSON documents and read back."""
    path, orders = new_folder(spark, "sections"), t["purchase_order"]
    sections = {
        "by_state": orders.groupBy(F.col("state").alias("label")).agg(F.count(F.lit(1)).alias("n")),
        "by_year": orders.groupBy(F.year("date_order").cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n")),
    }
    reports.write_report(sections, path, "json")
    read = [spark.read.schema("label string, n bigint").json(f"{path}/{s}").select(F.lit(s).alias("section"), "label", "n") for s in sections]
    return read[0].unionByName(read[1])


def written_logs(t, spark):
    """Log files of a folder, one for each job."""
    path = new_folder(spark, "logs")
    (t["log_lines"].select(F.regexp_replace("file_name", r"\.log$", "").alias("job"), "value").repartition("job")
     .write.partitionBy("job").text(path))
    return path


@register
def written_files(t, spark, folder):
    """Number and size of the files of a folder, their contents not read."""
    found = files.report_files(spark, written_logs(t, spark), (".txt",))
    return found.agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes"), F.count("mtime").alias("dated"))


@register
def log_levels(t, spark, folder):
    """Lines of real log files by level, with the number of files that have them."""
    lines = files.log_lines(spark, f"{written_logs(t, spark)}/*/*.txt")
    level = F.regexp_extract(F.trim("value"), r"^(\w+) - ", 1)
    return lines.groupBy(F.upper(level).alias("level")).agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("file_path").alias("files"),
        F.countDistinct("file_path", "line_no").alias("places"))


@register
def order_csv(t, spark, folder):
    """Order sheets written as CSV and read back by their header."""
    raw = source(spark, folder, "orders").select(
        F.col("o_totalprice").cast("string").alias("Total"), F.col("o_orderkey").cast("string").alias("PO"),
        F.concat(F.lit('say "'), "o_orderpriority", F.lit('", ok')).alias("Vendor"), F.col("o_orderstatus").alias("State"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), F.lit("x").alias("Unused"))
    columns = ["PO", "Vendor", "Date", "State", "Total"]
    return loose.order_sheet(loose.text_csv(spark, written_csv(raw, "orders"), columns, ["Total"]))


@register
def inventory_csv(t, spark, folder):
    """An inventory sheet written as CSV, read back by its header and classified."""
    raw = source(spark, folder, "part").select(
        F.col("p_retailprice").cast("string").alias("Cost"), F.col("p_name").alias("Product Name"),
        F.col("p_partkey").cast("string").alias("SKU"), F.col("p_type").alias("Category"),
        (F.col("p_partkey") % 50).cast("string").alias("Qty On Hand"), (F.col("p_partkey") % 7).cast("string").alias("Reserved"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("").alias("Reorder Min"),
        (F.col("p_size") * 20).cast("string").alias("Reorder Max"))
    return loose.inventory_sheet(loose.text_csv(spark, written_csv(raw, "parts")))


@register
def stringly_csv(t, spark, folder):
    raw = source(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("po"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(" units")))
        .when(F.col("o_orderkey") % 3 == 1, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("quantity"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon").alias("day"))
    return loose.coerce(raw, ["quantity"]).withColumn("day", dates.parse_day(F.col("day")))


# --- quality ---------------------------------------------------------------------------------

def expected_outputs(spark):
    return search._rows(spark, ("dataset", "output"), EXPECTED_OUTPUTS)


@register
def latest_files(t):
    return quality.latest_files(t["report_files"], attendance_marks=("signup",))


@register
def output_status(t, spark):
    return quality.output_status(expected_outputs(spark), t["report_files"], LOG_TIME)


@register
def dataset_health(t, spark):
    return quality.dataset_health(quality.output_status(expected_outputs(spark), t["report_files"], LOG_TIME))


@register
def health_overall(t, spark):
    outputs = quality.output_status(expected_outputs(spark), t["report_files"], LOG_TIME)
    return quality.health_overall(quality.dataset_health(outputs))


@register
def log_errors(t):
    return quality.log_errors(t["log_lines"])


def job_runs(t, spark, folder):
    return source(spark, folder, "events").select(
        F.concat(F.lit("job"), (F.col("user_id") % 7).cast("string")).alias("job"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("value").cast("decimal(18,2)").alias("duration_seconds"))


@register
def run_summary(t, spark, folder):
    return quality.run_summary(job_runs(t, spark, folder), quality.latest_files(t["report_files"]))


@register
def failed_jobs(t, spark, folder):
    return quality.failed_jobs(job_runs(t, spark, folder))
