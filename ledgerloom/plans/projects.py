"""Project plan: tasks with dependencies and open purchase money, hierarchy, schedule, summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions.dates import days_until, days_until_floor, inclusive_days
from ..functions.money import currency_code, line_pending, money_label, not_invoiced, order_reference, to_home, zero
from ..functions.status import is_blocked, is_completed, is_overdue, schedule_class
from ..functions.text import erp_link, html_to_summary, localized_only, or_blank, strip_tags
from ..operators.groups import list_cell, list_parts, mean_or_zero, percent_label
from ..operators.joins import look_up
from ..operators.ordered import numbered
from ..shared import settled
from ..sources.sizes import fits

AMOUNT = "decimal(38,4)"
ERP_URL = "https://erp.example.com/web#"


# --- parts of a task row ---------------------------------------------------------------------

def task_people(t: Mapping[str, DataFrame]) -> DataFrame:
    """(task, person) pairs."""
    users = t["res_users"].select(F.col("id").alias("user_id"), "partner_id")
    people = t["res_partner"].select(F.col("id").alias("partner_id"), F.col("name").alias("person"))
    return (
        t["project_task_user_rel"].join(users, "user_id").join(people, "partner_id").select("task_id", "person")
    )


def task_dependencies(t: Mapping[str, DataFrame]) -> DataFrame:
    """(task, task it waits for) pairs between active tasks, with the name of the latter."""
    active = t["project_task"].filter("active")
    waiting = active.select(F.col("id").alias("task_id"))
    awaited = active.select(F.col("id").alias("depends_on_id"), F.col("name").alias("_name"))
    number = F.col("depends_on_id").cast("string")
    return (
        t["task_dependencies_rel"].join(waiting, "task_id").join(awaited, "depends_on_id")
        .select("task_id", "depends_on_id", number.alias("depends_on"),
                F.concat("_name", F.lit(" ("), number, F.lit(")")).alias("dependency"))
    )


def order_pending(t: Mapping[str, DataFrame]) -> DataFrame:
    """Open amount per order, summed over its lines once — before any task repeats the order."""
    bills = t["account_move"].filter(
        "move_type = 'in_invoice' and state <> 'cancel' and payment_state <> 'paid'"
    ).select(F.col("id").alias("move_id"), F.abs("amount_residual_signed").alias("owed"))
    unpaid = (
        t["account_move_line"].filter("purchase_line_id is not null").select("move_id", "purchase_line_id")
        .join(bills, "move_id").groupBy("purchase_line_id").agg(F.max("owed").alias("owed"))
    )
    lines = t["purchase_order_line"]
    ordered, invoiced = F.col("product_qty"), F.col("qty_invoiced")
    # Bills decide only what is open of lines that are invoiced in full: the others are summed where they are and meet no bill.
    own = F.coalesce(not_invoiced(invoiced) | (invoiced < ordered), F.lit(False))
    no_bill = F.lit(None).cast("decimal(18,2)")
    pending = line_pending(ordered, invoiced, F.col("price_unit"), F.col("price_total"), no_bill)
    not_billed = lines.filter(own).select("order_id", pending.cast(AMOUNT).alias("pending"))
    billed = lines.filter(~own).select("order_id", F.col("id").alias("purchase_line_id")).join(unpaid, "purchase_line_id", "left")
    rows = not_billed.unionByName(billed.select("order_id", zero(F.col("owed")).cast(AMOUNT).alias("pending")))
    return rows.groupBy("order_id").agg(F.sum("pending").alias("pending"))


def task_orders(t: Mapping[str, DataFrame], rates=ref.RATES_TO_HOME) -> DataFrame:
    """(task, order) rows with reference text, currency and open amount in the home currency."""
    orders = t["purchase_order"].filter("state <> 'cancel'")
    orders = look_up(orders, t["res_currency"], "currency_id", "currency", {"name": "_currency"},
                     small=fits(t, "res_currency"))
    currency = currency_code(F.col("currency_id"), F.col("_currency"))
    orders = orders.select(F.col("id").alias("order_id"), "name", "state", "amount_total", currency.alias("currency"))
    orders = orders.join(order_pending(t), "order_id")
    links = t["project_task_purchase_order_rel"].select(
        "task_id", F.col("purchase_order_id").alias("order_id")).distinct()
    text = order_reference(F.col("name"), F.col("state"), F.col("currency"), F.col("amount_total"))
    return links.join(orders, "order_id").select(
        "task_id", "order_id", text.alias("po_reference"), "currency",
        to_home(F.col("pending"), F.col("currency"), rates).cast(AMOUNT).alias("pending_gtq"))


def task_people_parts(t: Mapping[str, DataFrame]) -> DataFrame:
    """All people of every task, in parts."""
    return list_parts(task_people(t), ["task_id"], "person")


def task_po_pending(orders: DataFrame) -> DataFrame:
    """Per task: number of orders, open amount, order references, currencies; ``orders`` is ``task_orders``."""
    rows = settled(orders)  # read for the sums, the references and their number
    # Currencies are few, whatever the number of orders; references are not and come in parts.
    used = F.nullif(F.array_join(F.array_sort(F.collect_set("currency")), ","), F.lit(""))
    sums = rows.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("po_count"), F.sum("pending_gtq").alias("total_po_amount"), used.alias("currencies_used"))
    return sums.join(list_cell(rows, ["task_id"], "po_reference", "po_references", "po_reference_count"), "task_id", "left")


def task_reference_parts(t: Mapping[str, DataFrame]) -> DataFrame:
    """All order references of every task, in parts."""
    return list_parts(task_orders(t), ["task_id"], "po_reference")


def plan_tasks(t: Mapping[str, DataFrame]) -> DataFrame:
    """Active tasks of active projects with project and status, without dependencies or money."""
    projects = t["project_project"].filter("active").select(
        F.col("id").alias("project_id"), localized_only("name").alias("project_name"),
        F.col("description").alias("project_description"), F.col("date_start").alias("project_start_date"),
        F.col("date").alias("project_end_date"))
    tasks = t["project_task"].filter("active").select(
        F.col("id").alias("task_id"), F.col("name").alias("task_name"),
        strip_tags(F.col("description")).alias("task_description"), "parent_id", "project_id", "sequence",
        F.col("fecha_inicio").alias("task_start_date"), F.col("date_deadline").alias("task_end_date"),
        F.col("date_end").alias("actual_end_date"), "stage_id", "is_closed",
        F.col("progress").alias("progress_percentage"), "planned_hours", "effective_hours", "remaining_hours")
    stages = t["project_task_type"].select("id", localized_only("name").alias("status"))
    df = look_up(tasks.join(projects, "project_id"), stages, "stage_id", "stage", {"status": "status"},
                 small=fits(t, "project_task_type"))
    return df.withColumns({
        "status": or_blank(F.col("status")),
        "task_level": F.when(F.col("parent_id").isNull(), 0).otherwise(1),
    }).drop("stage_id")


def with_order_money(tasks: DataFrame, orders: DataFrame) -> DataFrame:
    """Adds the number of orders and the open amount of each task; ``orders`` is ``task_orders``."""
    sums = orders.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("po_count"), F.sum("pending_gtq").alias("total_po_amount"),
        F.count_if(F.col("currency") == "USD").alias("usd_orders"))
    return tasks.join(sums, "task_id", "left").withColumns({
        "po_count": F.coalesce("po_count", F.lit(0)),
        "usd_orders": F.coalesce("usd_orders", F.lit(0)),
        "total_po_amount": zero(F.col("total_po_amount")).cast(AMOUNT),
    })


def project_tasks(t: Mapping[str, DataFrame], rates=ref.RATES_TO_HOME, *, tasks: DataFrame | None = None,
                  orders: DataFrame | None = None) -> DataFrame:
    """One row per active task of an active project, with everything the plan shows.

    ``tasks`` and ``orders`` take the place of ``plan_tasks`` and ``task_orders`` where a caller has them settled already.
    Lists are read for their values and for their number, so their links are settled.
    """
    people, edges = settled(task_people(t)), settled(task_dependencies(t))
    details = (
        list_cell(people, ["task_id"], "person", "assigned_to", "assigned_count"),
        list_cell(edges, ["task_id"], "dependency", "dependencies", "dependency_count"),
        list_cell(edges, ["task_id"], "depends_on", "dependency_ids", "_ids", separator=",").drop("_ids"),
        task_po_pending(task_orders(t, rates) if orders is None else orders),
    )
    df = plan_tasks(t) if tasks is None else tasks
    for side in details:
        df = df.join(side, "task_id", "left")
    counts = ("assigned_count", "dependency_count", "po_reference_count")
    return df.withColumns({
        **{c: F.coalesce(c, F.lit(0)) for c in counts},
        "po_count": F.coalesce("po_count", F.lit(0)),
        "total_po_amount": zero(F.col("total_po_amount")).cast(AMOUNT),
    })


def plan_list(tasks: DataFrame) -> DataFrame:
    """Tasks with their place in the plan: by project, parents with their children, by sequence."""
    family = F.coalesce("parent_id", "task_id")
    order = [F.asc_nulls_last("project_name"), family, F.asc_nulls_last("sequence"), F.col("task_id")]
    return numbered(tasks, order, "place")


# --- hierarchy -------------------------------------------------------------------------------

def open_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.filter(~is_completed(F.col("status")))


def _due_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(ref.FAR_FUTURE).cast("date"))


def _due(c: str) -> Column:
    return _due_of(F.col(c))


def _remaining(as_of: dt.date, now: dt.datetime | None) -> Column:
    end = F.col("task_end_date")
    return days_until_floor(end, now) if now else days_until(end, as_of)


def _headers(tasks: DataFrame, base_url: str) -> DataFrame:
    """One row per project of the frame, with its earliest task date and its sums."""
    keys = ("project_id", "project_name", "project_description", "project_start_date", "project_end_date")
    grouped = tasks.groupBy(*keys).agg(
        F.min("task_end_date").alias("_first_end"), F.sum("total_po_amount").alias("_total"))
    name = F.coalesce("project_name", F.concat(F.lit("Project "), F.col("project_id").cast("string")))
    return grouped.select(
        "project_id", _due("_first_end").alias("project_order"),
        F.lit(None).cast("date").alias("parent_order"), F.lit(None).alias("root_id"),
        F.lit(0).alias("level"), F.concat(F.lit("P"), F.col("project_id").cast("string")).alias("id"),
        F.upper(name).alias("name"), html_to_summary(F.col("project_description")).alias("description"),
        F.col("project_start_date").alias("start_date"), F.col("project_end_date").alias("end_date"),
        inclusive_days(F.col("project_start_date"), F.col("project_end_date")).alias("days"),
        F.lit(None).cast("int").alias("remaining_days"), F.lit("").alias("assigned_to"),
        F.lit("").alias("dependencies"), F.lit("PROJECT").alias("status"), F.lit(None).cast("bigint").alias("po_count"),
        money_label(F.col("_total")).alias("pending"), F.lit("").alias("po_references"),
        F.lit("Project").alias("type"), F.lit(True).alias("has_end_date"), F.lit("none").alias("schedule_class"),
        erp_link(base_url, F.col("project_id"), project=True).alias("link"),
    )


def _task_rows(tasks: DataFrame, as_of: dt.date, now, base_url: str) -> DataFrame:
    left = _remaining(as_of, now)
    top = F.col("parent_id").isNull()
    kind = F.when(top, "Task").otherwise("Subtask")
    name = F.coalesce("task_name", F.concat(kind, F.lit(" "), F.col("task_id").cast("string")))
    return tasks.select(
        "project_id", "project_order", "parent_order", "root_id",
        F.when(top, 1).otherwise(2).alias("level"), F.col("task_id").cast("string").alias("id"),
        F.concat(F.when(top, "").otherwise("  → "), name).alias("name"),
        html_to_summary(F.col("task_description")).alias("description"),
        F.col("task_start_date").alias("start_date"), F.col("task_end_date").alias("end_date"),
        inclusive_days(F.col("task_start_date"), F.col("task_end_date")).alias("days"),
        left.alias("remaining_days"), or_blank(F.col("assigned_to")).alias("assigned_to"),
        or_blank(F.col("dependencies")).alias("dependencies"), F.col("status"),
        F.when(F.col("po_count") > 0, F.col("po_count")).alias("po_count"),
        money_label(F.col("total_po_amount")).alias("pending"), or_blank(F.col("po_references")).alias("po_references"),
        kind.alias("type"), F.col("task_end_date").isNotNull().alias("has_end_date"),
        schedule_class(left, F.col("status")).alias("schedule_class"),
        erp_link(base_url, F.col("task_id"), project=False, project_id=F.col("project_id")).alias("link"),
    )


def project_hierarchy(t: Mapping[str, DataFrame], as_of: dt.date, *, only_open: bool = False,
                      now: dt.datetime | None = None, base_url: str = ERP_URL) -> DataFrame:
    """Projects, their root tasks and the children of these, with the keys that put them in order.

    Two levels are shown: a task below a child, or one whose parent is not in the frame or in
    another project, has no row (``hierarchy_orphans`` counts them). With ``now`` the days left
    are counted from that instant and rounded down; otherwise dates are compared.

    The tasks and their orders are settled: parents, project order, project sums and the full rows read them. No window
    gathers the tasks of a project.
    """
    keep = open_tasks if only_open else (lambda df: df)
    every, orders = settled(plan_tasks(t)), settled(task_orders(t))
    narrow = keep(every)
    parents = narrow.filter("parent_id is null").select(
        F.col("project_id").alias("_project"), F.col("task_id").alias("_parent"), _due("task_end_date").alias("_parent_end"))
    order = narrow.groupBy("project_id").agg(_due_of(F.min("task_end_date")).alias("project_order"))
    tasks = keep(project_tasks(t, tasks=every, orders=orders)).join(
        parents, (F.col("project_id") == F.col("_project")) & (F.col("parent_id") == F.col("_parent")), "left")
    shown = tasks.filter("parent_id is null or _parent is not null").join(order, "project_id").withColumns({
        "root_id": F.coalesce("parent_id", "task_id"),
        "parent_order": F.coalesce("_parent_end", _due("task_end_date"))})
    headers = _headers(with_order_money(narrow, orders), base_url)
    return headers.unionByName(_task_rows(shown, as_of, now, base_url))


def hierarchy_order() -> list[Column]:
    """Sort keys: earliest project, its header, each root task by date, its children by date."""
    return [F.col("project_order"), F.col("project_id"), F.asc_nulls_first("parent_order"),
            F.asc_nulls_first("root_id"), F.col("level"), _due("end_date"), F.col("id")]


def hierarchy_orphans(tasks: DataFrame, only_open: bool = False) -> DataFrame:
    """Per project, how many tasks the two-level hierarchy leaves out."""
    shown = open_tasks(tasks) if only_open else tasks
    roots = shown.filter("parent_id is null").select("project_id", F.col("task_id").alias("parent_id"))
    lost = shown.filter("parent_id is not null").join(roots, ["project_id", "parent_id"], "left_anti")
    return lost.groupBy("project_id").agg(F.count(F.lit(1)).alias("orphan_count"))


def gantt_rows(tasks: DataFrame, base_url: str = ERP_URL) -> DataFrame:
    """Task bars by project and end date; order them by project, ``sort_date`` and task."""
    return tasks.select(
        F.coalesce("project_name", F.lit("Proyecto sin nombre")).alias("project_name"),
        "task_id", F.coalesce("task_name", F.lit("Tarea sin nombre")).alias("task_name"),
        html_to_summary(F.col("task_description")).alias("task_description"), "task_start_date", "task_end_date",
        inclusive_days(F.col("task_start_date"), F.col("task_end_date")).alias("days"),
        "assigned_to", "dependencies", "po_count", "total_po_amount", "po_references",
        erp_link(base_url, F.col("task_id"), project=False, project_id=F.col("project_id")).alias("link"),
        _due("task_end_date").alias("sort_date"),
    )


# --- summaries -------------------------------------------------------------------------------

def project_order_refs(tasks: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct order references of every project, as rows."""
    return (
        orders.select("task_id", "po_reference").join(tasks.select("task_id", "project_id"), "task_id")
        .select("project_id", "po_reference").distinct()
    )


def project_reference_parts(t: Mapping[str, DataFrame]) -> DataFrame:
    """All order references of every project, in parts."""
    return list_parts(project_order_refs(plan_tasks(t), task_orders(t)), ["project_id"], "po_reference")


def explode_list(df: DataFrame, column: str, name: str, separator: str = ", ") -> DataFrame:
    """One row per element of a joined text."""
    return df.filter(F.col(column).isNotNull()).withColumn(name, F.explode(F.split(column, separator)))


def project_summary(t: Mapping[str, DataFrame], base_url: str = ERP_URL) -> DataFrame:
    """Progress, hours, open money and orders per project."""
    narrow, orders = settled(plan_tasks(t)), settled(task_orders(t))
    tasks = with_order_money(narrow, orders)
    keys = ("project_id", "project_name", "project_start_date", "project_end_date")
    done = F.count_if(is_completed(F.col("status")))
    sums = tasks.groupBy(*keys).agg(
        F.min("task_end_date").alias("_first_end"),
        F.count(F.lit(1)).alias("total_tasks"),
        done.alias("completed_tasks"),
        percent_label(done, F.count(F.lit(1))).alias("completed_pct"),
        F.round(F.coalesce(F.sum("planned_hours"), F.lit(0)), 1).alias("planned_hours"),
        F.round(F.coalesce(F.sum("effective_hours"), F.lit(0)), 1).alias("effective_hours"),
        mean_or_zero(F.col("progress_percentage")).alias("avg_progress"),
        money_label(F.sum("total_po_amount")).alias("pending"),
    )
    refs = list_cell(project_order_refs(narrow, orders), ["project_id"], "po_reference", "po_references", "po_ref_count")
    return sums.join(refs, "project_id", "left").select(
        "project_id",
        F.coalesce("project_name", F.concat(F.lit("Project "), F.col("project_id").cast("string"))).alias("project_name"),
        "project_start_date", "project_end_date", "total_tasks", "completed_tasks", "completed_pct",
        "planned_hours", "effective_hours", "avg_progress", "pending",
        F.coalesce("po_ref_count", F.lit(0)).alias("po_ref_count"), "po_references",
        erp_link(base_url, F.col("project_id"), project=True).alias("link"),
        _due("_first_end").alias("sort_date"),
    )


def project_summary_total(summary: DataFrame) -> DataFrame:
    """The TOTAL row below the project summary."""
    total, done = F.sum("total_tasks"), F.sum("completed_tasks")
    return summary.agg(
        total.alias("total_tasks"), done.alias("completed_tasks"), percent_label(done, total).alias("completed_pct"),
        F.sum("planned_hours").alias("planned_hours"), F.sum("effective_hours").alias("effective_hours"),
        F.avg("avg_progress").alias("avg_progress"))


def plan_stats(t: Mapping[str, DataFrame], as_of: dt.date, now: dt.datetime | None = None) -> DataFrame:
    """Counts over the whole plan, in one row: orders, completion, missing dates, due and overdue."""
    narrow, orders = settled(plan_tasks(t)), settled(task_orders(t))
    waiting = task_dependencies(t).select("task_id").distinct().withColumn("_waits", F.lit(True))
    tasks = with_order_money(narrow, orders).join(waiting, "task_id", "left")
    left = _remaining(as_of, now)
    done = is_completed(F.col("status"))
    main = tasks.agg(
        F.countDistinct("project_id").alias("projects"),
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(F.col("po_count") > 0).alias("tasks_with_orders"),
        F.sum("total_po_amount").alias("total_po_amount"),
        F.count_if(F.col("usd_orders") > 0).alias("tasks_with_usd"),
        F.count_if(~done).alias("open_tasks"),
        F.count_if(done).alias("completed_tasks"),
        percent_label(F.count_if(done), F.count(F.lit(1))).alias("completion_rate"),
        F.count_if(F.col("task_start_date").isNull()).alias("without_start"),
        F.count_if(F.col("task_end_date").isNull()).alias("without_end"),
        F.count_if("_waits").alias("with_dependencies"),
        F.count_if(is_blocked(F.col("status"))).alias("blocked"),
        F.count_if(~done & (left < 0)).alias("overdue"),
        F.count_if(is_overdue(left, F.col("is_closed"))).alias("overdue_open"),
        F.count_if(~done & left.between(0, 3)).alias("due_soon"),
    )
    refs = orders.join(narrow.select("task_id"), "task_id").agg(F.countDistinct("po_reference"))
    return main.withColumn("unique_order_refs", refs.scalar())
