"""Money and quantity expressions. Amounts stay decimal until they leave a mart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import reference_data as ref

def zero(c: Column) -> Column:
    """The amount, null counted as 0."""
    return F.coalesce(c, F.lit(0))


def currency_code(currency_id: Column, currency_name: Column) -> Column:
    """Code of a known currency id, else the name of the currency."""
    out = None
    for key, code in ref.CURRENCY_BY_ID.items():
        out = F.when(currency_id == key, code) if out is None else out.when(currency_id == key, code)
    return out.otherwise(currency_name)


def to_home(amount: Column, currency: Column, rates=ref.RATES_TO_HOME) -> Column:
    """Amount in the home currency; a currency without a rate counts one to one."""
    out = None
    for code, rate in rates.items():
        value = amount * F.lit(rate)
        out = F.when(currency == code, value) if out is None else out.when(currency == code, value)
    return out.otherwise(amount)


def not_invoiced(qty_invoiced: Column) -> Column:
    return F.coalesce(qty_invoiced, F.lit(0)) == 0


def line_pending(ordered: Column, invoiced: Column, unit_price: Column, total: Column, unpaid: Column) -> Column:
    """Open amount of an order line: all of it, the uninvoiced part, or what the bills still owe."""
    return (
        F.when(not_invoiced(invoiced), total)
        .when(invoiced < ordered, (ordered - invoiced) * unit_price)
        .otherwise(zero(unpaid))
    )


def header_pending(invoice_status: Column, total: Column, unpaid: Column) -> Column:
    """Open amount of an order by its invoice status."""
    return F.when(invoice_status.isin("no", "to invoice"), total).otherwise(zero(unpaid))


def value_per_unit(value: Column, quantity: Column) -> Column:
    return F.when(quantity > 0, value / quantity).otherwise(F.lit(0)).cast("decimal(18,4)")


def money_label(c: Column, symbol: str = "Q") -> Column:
    """``Q1,234.56``; blank for zero and null."""
    rounded = F.round(c.cast("decimal(38,4)"), 2)
    return F.when(zero(c) != 0, F.concat(F.lit(symbol), F.format_number(rounded, 2))).otherwise("")


def plain_amount(c: Column) -> Column:
    """Amount rounded to two decimals, as text with exactly two decimals."""
    return c.cast("decimal(38,2)").cast("string")


def order_reference(name: Column, state: Column, currency: Column, total: Column) -> Column:
    """Order number as shown in a plan: requests are marked, foreign totals are added."""
    return F.concat(
        F.when(state == "draft", "RFQ-").otherwise(""),
        name,
        F.when(currency == "USD", F.concat(F.lit(" ($"), plain_amount(total), F.lit(")"))).otherwise(""),
    )
