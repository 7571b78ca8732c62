"""Classification expressions. Branch order matters: the first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import reference_data as ref
from .money import not_invoiced


def movement_type(src: Column, dst: Column, src_usage: Column, dst_usage: Column,
                  main=ref.MAIN_STOCK_LOCATIONS) -> Column:
    def either(usage: str) -> Column:
        return (src_usage == usage) | (dst_usage == usage)

    return (
        F.when(dst.isin(*main), "Stock In")
        .when(src.isin(*main), "Stock Out")
        .when(src_usage == "supplier", "Receipt from Supplier")
        .when(dst_usage == "customer", "Delivery to Customer")
        .when(either("production"), "Production Movement")
        .when(either("inventory"), "Inventory Adjustment")
        .otherwise("Internal Transfer")
    )


def partner_type(src_usage: Column, dst_usage: Column) -> Column:
    return F.when(src_usage == "supplier", "Supplier").when(dst_usage == "customer", "Customer").otherwise("Internal")


def reception_status(received: Column, ordered: Column, null_is_zero: bool = True) -> Column:
    """How much of an order line arrived. As stored, a null quantity would read as fully received."""
    received = F.coalesce(received, F.lit(0)) if null_is_zero else received
    return (
        F.when(received == 0, "Not Received").when(received < ordered, "Partially Received")
        .otherwise("Fully Received")
    )


def payment_status(invoiced: Column, ordered: Column, unpaid: Column) -> Column:
    return (
        F.when(not_invoiced(invoiced), "Not Invoiced")
        .when(invoiced < ordered, "Partially Invoiced")
        .when(unpaid > 0, "Invoiced - Unpaid")
        .otherwise("Paid")
    )


def stock_level(available: Column, reorder_min: Column, reorder_max: Column) -> Column:
    above = (reorder_max > 0) & (available > reorder_max * F.lit(1.5))
    return (
        F.when(available <= 0, "critical")
        .when((reorder_min > 0) & (available <= reorder_min), "low")
        .when((reorder_min > 0) & above, "over")
        .otherwise("ok")
    )


def presence(check_in: Column, check_out: Column) -> Column:
    return F.when(check_out.isNull(), "INSIDE").when(check_out > check_in, "OUTSIDE").otherwise("UNKNOWN")


def dwell_alert(micros: Column, warn_hours: int = 10, danger_hours: int = 12) -> Column:
    hour = 3_600_000_000
    return (
        F.when(micros > danger_hours * hour, "danger").when(micros > warn_hours * hour, "warning")
        .otherwise("normal")
    )


def is_completed(status: Column) -> Column:
    return F.coalesce(status, F.lit("")).isin(*ref.COMPLETED_STATUSES)


def is_blocked(status: Column) -> Column:
    return F.lower(F.coalesce(status, F.lit(""))).rlike("bloqueado|blocked")


def is_overdue(days_until: Column, is_closed: Column) -> Column:
    """Past its date and known to be open; an unknown closed flag is not overdue."""
    return F.coalesce((days_until < 0) & ~is_closed, F.lit(False))


def schedule_class(days_until: Column, status: Column, soon: int = 3) -> Column:
    return (
        F.when(days_until < 0, "overdue").when(is_blocked(status), "blocked")
        .when(days_until.between(0, soon), "due_soon").otherwise("none")
    )


def freshness(age_hours: Column, missing: Column, stale_after: float = ref.STALE_AFTER_HOURS) -> Column:
    return (
        F.when(age_hours.isNull(), "missing").when(age_hours > stale_after, "stale")
        .when(missing > 0, "partial").otherwise("ok")
    )
