"""Vendor bills: linkage to purchase orders, ageing, sections and key figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day, days_overdue
from ..functions.money import currency_code
from ..functions.text import html_to_lines, localized_nonblank, squash_lines
from ..operators.groups import list_cell, list_parts
from ..operators.joins import join_in_place, look_up
from ..operators.ordered import numbered
from ..shared import settled
from ..sources.sizes import fits

HEADER_TEXT = ("bill_number", "vendor_reference", "invoice_origin", "supplier_name", "supplier_phone",
               "supplier_email", "bill_notes", "po_numbers")
LINE_TEXT = ("line_label", "line_ref", "product_name", "product_code")


def _order_names(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["purchase_order"].select(F.col("id").alias("order_id"), F.col("name").alias("po_number"))


def links_from_relation(t: Mapping[str, DataFrame]) -> DataFrame:
    """(bill, order number) pairs recorded directly."""
    pairs = t["account_move_purchase_order_rel"].select(
        F.col("account_move_id").alias("move_id"), F.col("purchase_order_id").alias("order_id")).distinct()
    return pairs.join(_order_names(t), "order_id").select("move_id", "po_number")


def links_from_lines(t: Mapping[str, DataFrame]) -> DataFrame:
    """(bill, order number) pairs found through the billed order lines."""
    lines = t["account_move_line"].filter("purchase_line_id is not null").select("move_id", "purchase_line_id")
    orders = t["purchase_order_line"].select(F.col("id").alias("purchase_line_id"), "order_id")
    pairs = lines.join(orders, "purchase_line_id").select("move_id", "order_id").distinct()
    return pairs.join(_order_names(t), "order_id").select("move_id", "po_number")


def bill_orders(t: Mapping[str, DataFrame]) -> DataFrame:
    """Orders of every bill as rows: the recorded ones, else those of its lines."""
    direct = links_from_relation(t)
    found = links_from_lines(t).join(direct.select("move_id").distinct(), "move_id", "left_anti")
    return direct.unionByName(found).distinct()


def bill_order_parts(t: Mapping[str, DataFrame]) -> DataFrame:
    """All order numbers of every bill, in parts."""
    return list_parts(bill_orders(t), ["move_id"], "po_number")


def bills(t: Mapping[str, DataFrame], as_of: dt.date, *, only_posted: bool = True, sign: str = "as_is",
          decode=None, orders: bool = True) -> DataFrame:
    """One row per vendor bill with its orders, due date and days overdue.

    ``sign='abs'`` takes the amount of the residual whatever its sign. Sums and counts of bills need no ``orders``; without
    them the columns of the orders are null and no line is read.
    """
    states = ("posted",) if only_posted else ("draft", "posted")
    moves = t["account_move"].filter("move_type = 'in_invoice'").filter(F.col("state").isin(*states))
    df = moves.join(t["res_partner"].select(
        F.col("id").alias("partner_id"), F.col("name").alias("supplier_name"), F.col("phone").alias("supplier_phone"),
        F.col("email").alias("supplier_email")), "partner_id")
    df = look_up(df, t["res_currency"], "currency_id", "currency", {"name": "_currency"}, small=fits(t, "res_currency"))
    if orders:
        # Settled, as a list is read for its values and for their number: the lines meet their orders once.
        found = list_cell(settled(bill_orders(t)), ["move_id"], "po_number", "po_numbers", "po_count")
        df = look_up(df, found, "id", "orders", {"po_numbers": "po_numbers", "po_count": "po_count"}, key="move_id")
    else:
        df = df.withColumns({"po_numbers": F.lit(None).cast("string"), "po_count": F.lit(None).cast("bigint")})

    residual = F.col("amount_residual_signed")
    residual = F.abs(residual) if sign == "abs" else residual
    due = F.coalesce("invoice_date_due", "invoice_date", "date")
    out = df.select(
        F.col("id").alias("bill_id"), F.col("name").alias("bill_number"), F.col("state").alias("bill_state"),
        "payment_state", F.col("ref").alias("vendor_reference"), "invoice_origin", "invoice_date",
        "invoice_date_due", F.col("date").alias("accounting_date"),
        F.col("amount_total_signed").alias("bill_total_signed"), residual.alias("bill_residual_signed"),
        currency_code(F.col("currency_id"), F.col("_currency")).alias("currency"),
        "supplier_name", "supplier_phone", "supplier_email",
        html_to_lines(F.col("narration"), squeeze_spaces=False, **({"decode": decode} if decode else {}))
        .alias("bill_notes"),
        "po_numbers", (F.coalesce("po_count", F.lit(0)) if orders else F.col("po_count")).alias("po_count"),
        (F.col("amount_total_signed") - residual).alias("amount_paid_signed"),
        due.alias("effective_due_date"),
        F.when(residual > 0, days_overdue(due, as_of)).otherwise(0).alias("days_overdue"),
    )
    return out.withColumns({c: squash_lines(F.col(c)) for c in HEADER_TEXT})


def vendor_bills(t: Mapping[str, DataFrame], headers: DataFrame) -> DataFrame:
    """Bill headers with their lines; a bill without lines stays once."""
    products = (
        t["product_product"].select("id", "product_tmpl_id", "default_code")
        .join(t["product_template"].select(F.col("id").alias("product_tmpl_id"), F.col("name").alias("_name")),
              "product_tmpl_id", "left")
        .select(F.col("id").alias("product_id"), squash_lines(localized_nonblank("_name")).alias("product_name"),
                squash_lines(F.col("default_code")).alias("product_code"))
    )
    lines = t["account_move_line"].select(
        F.col("id").alias("line_id"), F.col("move_id").alias("bill_id"), squash_lines(F.col("name")).alias("line_label"),
        "display_type", "quantity", "price_unit", "price_subtotal", "price_total",
        squash_lines(F.col("ref")).alias("line_ref"), "sequence", "product_id")
    # The products come to the lines, which are shuffled once, by their bill.
    lines = join_in_place(lines, lines, products, "bill_id", "product_id", "left",
                          small=fits(t, "product_product", "product_template")).drop("product_id")
    return headers.join(lines, "bill_id", "left").na.fill("", list(LINE_TEXT))


def bill_list(lines: DataFrame) -> DataFrame:
    """Bill lines with their place in the list: due date, newest bill first inside a date, then line order."""
    order = [F.asc_nulls_last("effective_due_date"), F.desc_nulls_last("invoice_date"), F.desc("bill_id"),
             F.asc_nulls_last("sequence"), F.asc_nulls_last("line_id")]
    return numbered(lines, order, "place")


# --- sections --------------------------------------------------------------------------------

def _highlight(residual_flag: bool) -> Column:
    late = F.when(F.col("days_overdue") > 0, "overdue")
    return (late.when(F.col("bill_residual_signed") > 0, "pending") if residual_flag else late).otherwise("none")


SECTION = ("bill_id", "effective_due_date", "days_overdue", "bill_number", "supplier_name", "currency",
           "bill_total_signed", "amount_paid_signed", "bill_residual_signed", "payment_state", "bill_state",
           "po_numbers", "vendor_reference", "invoice_origin", "bill_notes")


def unpaid(headers: DataFrame) -> DataFrame:
    return headers.filter("bill_residual_signed > 0")


def paid(headers: DataFrame) -> DataFrame:
    """Bills without residual. A bill with an unknown residual is neither paid nor unpaid."""
    return headers.filter("bill_residual_signed <= 0")


def bills_next_days(headers: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Unpaid bills due from today through today + ``days``, both included."""
    last = as_of + dt.timedelta(days=days)
    return (
        unpaid(headers).filter(F.col("effective_due_date").between(day(as_of), day(last)))
        .select(*SECTION, _highlight(True).alias("highlight"))
        .orderBy("effective_due_date", "supplier_name", F.desc("bill_residual_signed"), "bill_id")
    )


def bills_unpaid(headers: DataFrame) -> DataFrame:
    return unpaid(headers).select(*SECTION, _highlight(False).alias("highlight")).orderBy(
        F.desc("days_overdue"), F.asc_nulls_last("effective_due_date"), F.desc("bill_residual_signed"), "bill_id")


def bills_paid(headers: DataFrame) -> DataFrame:
    columns = [c for c in SECTION if c not in ("effective_due_date", "days_overdue")]
    return paid(headers).select("invoice_date", *columns).orderBy(
        F.desc_nulls_last("invoice_date"), F.desc("bill_number"))


def bill_lines(lines: DataFrame) -> DataFrame:
    """Real lines only: section and note lines are left out."""
    return lines.filter("display_type is null").select(
        "line_id", "bill_number", "supplier_name", "currency", "effective_due_date", "payment_state", "bill_state",
        "po_numbers", "vendor_reference", "invoice_origin", "product_code", "product_name", "line_label",
        "quantity", "price_unit", "price_subtotal", "price_total")


def bill_stats(headers: DataFrame) -> DataFrame:
    """Key figures of the bills, in one row, with the all-zero-residual warning."""
    late = (F.col("bill_residual_signed") > 0) & (F.col("days_overdue") > 0)
    late_days = F.sum(F.when(late, F.col("days_overdue")))
    return headers.agg(
        F.count(F.lit(1)).alias("bills"),
        F.count_if(F.col("bill_residual_signed") > 0).alias("unpaid_bills"),
        F.count_if(F.col("bill_residual_signed") <= 0).alias("paid_bills"),
        F.coalesce(F.max("bill_residual_signed") == 0, F.lit(False)).alias("all_residuals_zero"),
        F.count_if(late).alias("overdue_bills"),
        F.coalesce(late_days.cast("double") / F.nullif(F.count_if(late), F.lit(0)), F.lit(0.0)).alias("avg_days_overdue"),
    )


def bills_pending_by_currency(headers: DataFrame) -> DataFrame:
    return (
        unpaid(headers).filter("currency is not null").groupBy("currency")
        .agg(F.sum("bill_residual_signed").alias("pending")).orderBy("currency")
    )
