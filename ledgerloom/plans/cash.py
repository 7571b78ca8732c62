"""Cash requirements of open purchase orders and their weekly calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions.dates import day, week_index, week_label, week_start
from ..functions.money import currency_code, header_pending, to_home, zero
from ..functions.text import html_to_lines, label_of, localized_only
from ..operators.groups import spread, with_total
from ..operators.joins import look_up
from ..operators.ordered import numbered, top_n_per_key
from ..sources.sizes import fits

NO_PROJECT, NO_TASK = "Sin Proyecto", "Sin Tarea"
MONEY_SUM = "decimal(38,4)"
STATUS_COLUMNS = ("draft", "sent", "purchase")
OVERDUE_WEEK = -1


def order_bill_links(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (bill, order) with the number of bill lines behind it."""
    lines = t["account_move_line"].filter("purchase_line_id is not null").select("move_id", "purchase_line_id")
    orders = t["purchase_order_line"].select(F.col("id").alias("purchase_line_id"), "order_id")
    return (
        lines.join(orders, "purchase_line_id")
        .groupBy("move_id", "order_id").agg(F.count(F.lit(1)).alias("line_count"))
    )


def unpaid_per_order(t: Mapping[str, DataFrame], per_line: bool = False) -> DataFrame:
    """What bills still owe per order. ``per_line`` adds a bill once for each of its lines."""
    bills = t["account_move"].filter(
        "move_type = 'in_invoice' and state <> 'cancel' and (payment_state <> 'paid')"
    ).select(F.col("id").alias("move_id"), "amount_residual_signed")
    owed = F.col("amount_residual_signed") * (F.col("line_count") if per_line else F.lit(1))
    return (
        order_bill_links(t).join(bills, "move_id")
        .groupBy("order_id").agg(F.sum(owed.cast(MONEY_SUM)).alias("unpaid"))
    )


def order_tasks(t: Mapping[str, DataFrame]) -> DataFrame:
    """Task, dates and project of every order linked to a task; an inactive task has no details."""
    projects = t["project_project"].filter("active").select(
        F.col("id").alias("project_id"), localized_only("name").alias("project_name"))
    tasks = (
        t["project_task"].filter("active").join(projects, "project_id")
        .select(F.col("id").alias("_task"), F.col("name").alias("task_name"), "fecha_inicio", "date_deadline",
                "project_name", "project_id")
    )
    links = t["project_task_purchase_order_rel"].select("task_id", F.col("purchase_order_id").alias("_order"))
    return links.join(tasks, F.col("task_id") == F.col("_task"), "left").drop("_task")


def cash_requirements(t: Mapping[str, DataFrame], *, allocate: str = "full", per_line: bool = False) -> DataFrame:
    """Open orders with amounts due, one row per order and linked task.

    With ``allocate='full'`` every task row carries the whole order; ``'even'`` divides the
    amounts by the number of tasks.
    """
    orders = t["purchase_order"].filter(F.col("state").isin(*ref.OPEN_PO_STATES))
    df = orders.join(
        t["res_partner"].select(F.col("id").alias("partner_id"), F.col("name").alias("supplier_name"),
                                F.col("vat").alias("supplier_nit")), "partner_id")
    df = look_up(df, t["res_currency"], "currency_id", "currency", {"name": "_currency"}, small=fits(t, "res_currency"))
    df = look_up(df, unpaid_per_order(t, per_line), "id", "unpaid", {"unpaid": "_unpaid"}, key="order_id",
                 small=fits(t, "purchase_order"))
    links = order_tasks(t)
    if allocate == "even":
        shares = links.groupBy("_order").agg(F.count(F.lit(1)).alias("_shares"))
        df = look_up(df, shares, "id", "shares", {"_shares": "_shares"}, key="_order",
                     small=fits(t, "project_task_purchase_order_rel"))
    else:
        df = df.withColumn("_shares", F.lit(1))
    df = df.join(links, F.col("id") == F.col("_order"), "left")

    currency = currency_code(F.col("currency_id"), F.col("_currency"))
    share = F.coalesce(F.col("_shares"), F.lit(1))

    def part(amount: Column) -> Column:
        return (amount / share if allocate == "even" else amount).cast("decimal(18,4)")

    return df.select(
        F.col("id").alias("po_id"),
        F.col("name").alias("po_number"),
        F.col("state").alias("po_state"),
        label_of(F.col("state"), ref.CASH_STATE_LABELS).alias("state_display"),
        F.col("date_order").alias("order_date"),
        F.col("date_planned").alias("planned_date"),
        F.col("amount_total").alias("po_total"),
        F.col("amount_untaxed").alias("po_subtotal"),
        F.col("amount_tax").alias("po_tax"),
        "supplier_name", "supplier_nit",
        currency.alias("currency"),
        part(to_home(F.col("amount_total"), currency)).alias("amount_gtq"),
        "task_id",
        F.coalesce("task_name", F.lit(NO_TASK)).alias("task_name"),
        F.col("fecha_inicio").alias("task_start_date"),
        F.col("date_deadline").alias("task_end_date"),
        F.coalesce("project_name", F.lit(NO_PROJECT)).alias("project_name"),
        "project_id",
        F.coalesce("fecha_inicio", "date_planned", "date_order").alias("payment_date"),
        part(header_pending(F.col("invoice_status"), F.col("amount_total"), F.col("_unpaid"))).alias("amount_pending"),
        F.col("internal_notes").alias("notes"),
        "invoice_status", "receipt_status",
    )


def cash_detail(requirements: DataFrame) -> DataFrame:
    """The requirements with their place in payment order, notes as plain text."""
    order = [F.asc_nulls_first("payment_date"), F.col("po_number"), F.col("task_id")]
    return numbered(requirements, order, "place").withColumn("notes", html_to_lines(F.col("notes")))


# --- weekly calendar -------------------------------------------------------------------------

def cash_payments(requirements: DataFrame, as_of: dt.date, weeks_ahead: int = 12, *,
                  overdue: bool = False, mode: str = "pending") -> DataFrame:
    """Requirements that fall in the calendar, with their week and the amounts that count.

    A missing payment date counts as today. Earlier weeks are left out, or kept as week −1 with
    ``overdue``. ``mode='pending'`` counts what is still due, converted. ``mode='as_reported'``
    counts the pending amount of home-currency rows but the full converted amount of all others.
    """
    monday = week_start(as_of)
    week = week_index(F.coalesce("payment_date", day(as_of)), monday)
    df = requirements.withColumn("week_no", week)
    df = df.withColumn("week_no", F.greatest("week_no", F.lit(OVERDUE_WEEK))) if overdue else df.filter("week_no >= 0")
    df = df.filter(F.col("week_no") <= weeks_ahead)
    pending, currency = zero(F.col("amount_pending")), F.col("currency")
    home = F.coalesce(currency == ref.HOME_CURRENCY, F.lit(False))
    if mode == "as_reported":
        gtq = F.when(home, pending).otherwise(F.col("amount_gtq"))
        usd = F.when(~home, pending).otherwise(F.lit(0))
        grouped = F.col("amount_gtq")
    else:
        gtq = to_home(pending, currency)
        usd = F.when(currency == "USD", pending).otherwise(F.lit(0))
        grouped = gtq
    return df.withColumns({
        "week_gtq": gtq.cast(MONEY_SUM), "week_usd": usd.cast(MONEY_SUM), "group_gtq": grouped.cast(MONEY_SUM)})


def week_calendar(spark, as_of: dt.date, weeks_ahead: int = 12, overdue: bool = False) -> DataFrame:
    """One row per week of the horizon, whether or not anything is due in it."""
    weeks = spark.range(OVERDUE_WEEK if overdue else 0, weeks_ahead + 1, numPartitions=1)
    start = F.date_add(day(week_start(as_of)), (F.col("id") * 7).cast("int"))
    late = F.col("id") == OVERDUE_WEEK
    return weeks.select(
        F.col("id").cast("int").alias("week_no"),
        start.alias("week_start"),
        F.date_add(start, 6).alias("week_end"),
        F.when(late, "Vencido").otherwise(week_label(start)).alias("week_label"),
    )


def weekly_cash_flow(requirements: DataFrame, as_of: dt.date, weeks_ahead: int = 12, *,
                     overdue: bool = False, mode: str = "pending") -> DataFrame:
    """Orders and amounts due per week; weeks without payments appear with zeros."""
    payments = cash_payments(requirements, as_of, weeks_ahead, overdue=overdue, mode=mode)
    sums = payments.groupBy("week_no").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("week_gtq").alias("total_gtq"),
        F.sum("week_usd").alias("total_usd"),
        *spread(F.col("po_state"), list(STATUS_COLUMNS), F.col("group_gtq"), lambda _, s: s),
    )
    weeks = week_calendar(requirements.sparkSession, as_of, weeks_ahead, overdue)
    return weeks.join(sums, "week_no", "left").na.fill(0).orderBy("week_no")


def cash_totals(weekly: DataFrame) -> DataFrame:
    """The weeks with a TOTAL row."""
    amounts = ("count", "total_gtq", "total_usd", *STATUS_COLUMNS)
    return with_total(weekly, "week_label", [F.sum(c).alias(c) for c in amounts])


def cash_project_pivot(requirements: DataFrame, as_of: dt.date, weeks_ahead: int = 12, *,
                       mode: str = "pending") -> DataFrame:
    """Projects by weeks with row and column totals; a project without payment in a week has 0."""
    payments = cash_payments(requirements, as_of, weeks_ahead, mode=mode)
    weeks = spread(F.col("week_no"), list(range(weeks_ahead + 1)), F.col("group_gtq"), lambda i, _: f"week_{i:02d}")
    return with_total(payments, "project_name", [*weeks, F.sum("group_gtq").alias("total")])


def cash_top_projects(requirements: DataFrame, as_of: dt.date, weeks_ahead: int = 12, *, k: int = 5,
                      mode: str = "pending") -> DataFrame:
    """The largest projects of every week."""
    payments = cash_payments(requirements, as_of, weeks_ahead, mode=mode)
    sums = payments.groupBy("week_no", "project_name").agg(F.sum("group_gtq").alias("amount"))
    return top_n_per_key(sums, ["week_no"], [F.desc("amount"), F.col("project_name")], k)


def cash_document(weekly: DataFrame, top: DataFrame) -> DataFrame:
    """One nested document per week: totals, amounts by state, largest projects."""
    projects = top.groupBy("week_no").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "project_name", "amount"))),
        lambda p: F.struct(p.project_name.alias("project"), p.amount.alias("amount"))).alias("top_projects"))
    return weekly.join(projects, "week_no", "left").select(
        "week_start", "week_end", F.col("week_label").alias("label"), "total_gtq", "total_usd", "count",
        F.struct(*STATUS_COLUMNS).alias("by_status"),
        F.coalesce("top_projects", F.array().cast("array<struct<project:string,amount:decimal(38,4)>>"))
        .alias("top_projects"),
    )
