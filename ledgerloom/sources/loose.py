"""Readers for inputs whose types and header spelling are not under control."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import number_or_zero


def text_csv(spark: SparkSession, path: str, columns: list[str] | None = None, numeric: list[str] = (),
             multi_line: bool = False) -> DataFrame:
    """CSV with a header, columns found by their name in it and read as text; ``numeric`` ones become numbers (0 if none).

    Without ``columns`` all are read. A missing column is an error, and so is a file whose header differs from the first
    one's. ``multi_line`` allows line ends inside quotes; each file is then one task.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    missing = [c for c in columns or () if c not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = reader.schema(schema).option("enforceSchema", False).csv(path)
    return coerce(df.select(*[F.col(f"`{c}`") for c in columns or names]), numeric)


def coerce(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Turn text columns into numbers; what is no number becomes 0."""
    return df.withColumns({c: number_or_zero(F.col(c).cast("string")) for c in numeric})


def normal_header(name: str) -> str:
    """Lower case, blanks and slashes as one underscore, nothing but letters, digits, underscores."""
    return re.sub(r"[^a-z0-9_]", "", re.sub(r"[\s/]+", "_", name.lower()))


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column to its normal form; of equal names the last one counts."""
    last = {normal_header(name): i for i, name in enumerate(df.columns)}
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{i}").alias(n) for n, i in last.items()])


def first_text(df: DataFrame, aliases: list[str], default: str = "") -> Column:
    """First alias that is present and not blank."""
    known = [F.nullif(F.col(a).cast("string"), F.lit("")) for a in aliases if a in df.columns]
    return F.coalesce(*known, F.lit(default))


def first_number(df: DataFrame, aliases: list[str], default: Column | float = 0.0) -> Column:
    """First alias that is present and neither blank nor zero, as a number."""
    known = []
    for a in aliases:
        if a in df.columns:
            text = F.col(a).cast("string")
            # A text such as '0' is not blank and ends the search; a numeric zero does not.
            numeric = dict(df.dtypes)[a] != "string"
            known.append(F.nullif(number_or_zero(text), F.lit(0.0)) if numeric
                         else F.when(text != "", number_or_zero(text)))
    fallback = default if isinstance(default, Column) else F.lit(float(default))
    return F.coalesce(*known, fallback)


# Header spellings accepted for a purchase-order sheet.
ORDER_ALIASES = {
    "po_name": ["po_name", "order_reference", "name", "po", "reference"],
    "vendor": ["vendor", "partner", "supplier", "vendor_name", "partner_name"],
    "order_date": ["order_date", "date_order", "date", "order_deadline"],
    "status": ["status", "state", "order_status"],
    "total_amount": ["total_amount", "amount_total", "total", "amount"],
    "received_pct": ["received_pct", "received", "qty_received_pct"],
    "invoiced_pct": ["invoiced_pct", "invoiced", "qty_invoiced_pct"],
    "currency": ["currency", "currency_id"],
    "product_count": ["product_count", "line_count", "products"],
}

# Header spellings accepted for an inventory sheet.
INVENTORY_ALIASES = {
    "product": ["product", "product_name", "name", "display_name"],
    "sku": ["sku", "default_code", "internal_reference", "ref", "barcode"],
    "category": ["category", "product_category", "categ", "categ_id"],
    "location": ["location", "location_name", "warehouse"],
    "uom": ["uom", "unit", "uom_name"],
    "qty_on_hand": ["qty_on_hand", "quantity_on_hand", "on_hand", "qty", "stock"],
    "qty_reserved": ["qty_reserved", "reserved", "qty_outgoing"],
    "qty_available": ["qty_available", "available", "free_qty"],
    "reorder_point": ["reorder_point", "reorder_min", "min_qty", "orderpoint_min"],
    "reorder_max": ["reorder_max", "max_qty", "orderpoint_max"],
    "unit_cost": ["unit_cost", "cost", "standard_price", "price"],
    "total_value": ["total_value", "value"],
    "demand": ["demand", "qty_demand", "forecasted_demand"],
}


def order_sheet(raw: DataFrame) -> DataFrame:
    """A loosely named purchase-order sheet with settled names and types."""
    df = normalise_headers(raw)
    a = ORDER_ALIASES
    date_text = first_text(df, a["order_date"])
    parsed = F.date_format(F.try_to_timestamp(F.substring(date_text, 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd")
    return df.select(
        first_text(df, a["po_name"]).alias("po_name"),
        first_text(df, a["vendor"]).alias("vendor"),
        F.coalesce(parsed, F.substring(date_text, 1, 10)).alias("order_date"),
        first_text(df, a["status"]).alias("status"),
        first_number(df, a["total_amount"]).alias("total_amount"),
        first_number(df, a["received_pct"]).alias("received_pct"),
        first_number(df, a["invoiced_pct"]).alias("invoiced_pct"),
        first_text(df, a["currency"], "GTQ").alias("currency"),
        first_number(df, a["product_count"]).cast("int").alias("product_count"),
    )


def inventory_sheet(raw: DataFrame) -> DataFrame:
    """A loosely named inventory sheet with settled names, types and derived quantities."""
    from ..plans.inventory import classify_levels

    df = normalise_headers(raw)
    a = INVENTORY_ALIASES
    texts = ("product", "sku", "category", "location", "uom")
    plain = ("qty_on_hand", "qty_reserved", "reorder_point", "reorder_max", "unit_cost", "demand")
    base = df.select("*", *[first_text(df, a[c]).alias(f"_{c}") for c in texts],
                     *[first_number(df, a[c]).alias(f"_{c}") for c in plain])
    available = first_number(df, a["qty_available"], F.col("_qty_on_hand") - F.col("_qty_reserved"))
    value = first_number(df, a["total_value"], F.col("_qty_on_hand") * F.col("_unit_cost"))
    rows = base.select(*[F.col(f"_{c}").alias(c) for c in (*texts, *plain)],
                       available.alias("qty_available"), value.alias("total_value"))
    return classify_levels(rows)
