"""Inventory position per product, stock levels and alerts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import reference_data as ref
from ..functions.money import zero
from ..functions.status import stock_level
from ..functions.text import localized

NO_CATEGORY = "Sin Categoría"
QTY_SUM = "decimal(38,4)"


def _total(c: str, name: str) -> Column:
    return F.sum(c).cast(QTY_SUM).alias(name)


def on_hand(t: Mapping[str, DataFrame]) -> DataFrame:
    """Quantity per product over internal locations.

    Quants are summed per (product, location) first, so what meets the locations is small.
    """
    per_place = t["stock_quant"].groupBy("product_id", "location_id").agg(F.sum("quantity").alias("quantity"))
    internal = t["stock_location"].filter("usage = 'internal'").select(F.col("id").alias("location_id"))
    return per_place.join(internal, "location_id").groupBy("product_id").agg(_total("quantity", "on_hand"))


def open_demand(t: Mapping[str, DataFrame]) -> DataFrame:
    """Quantity that open moves still take for open production orders."""
    moves = (
        t["stock_move"].filter(~F.col("state").isin(*ref.CLOSED_STATES))
        .filter(F.col("raw_material_production_id").isNotNull())
        .groupBy("raw_material_production_id", "product_id").agg(F.sum("product_uom_qty").alias("qty"))
    )
    orders = t["mrp_production"].filter(~F.col("state").isin(*ref.CLOSED_STATES)).select(
        F.col("id").alias("raw_material_production_id"))
    return moves.join(orders, "raw_material_production_id").groupBy("product_id").agg(_total("qty", "open_demand"))


def consumed(t: Mapping[str, DataFrame]) -> DataFrame:
    """Quantity already taken by open production moves, whatever the state of their order."""
    return (
        t["stock_move"]
        .filter(F.col("raw_material_production_id").isNotNull())
        .filter(~F.col("state").isin(*ref.CLOSED_STATES))
        .filter(F.col("quantity_done") > 0)
        .groupBy("product_id").agg(_total("quantity_done", "consumed"))
    )


def inventory_position(t: Mapping[str, DataFrame]) -> DataFrame:
    """On hand, open demand, consumed and available per active stockable product."""
    products = t["product_product"].filter("active").select("id", "product_tmpl_id")
    templates = (
        t["product_template"].filter("active and type = 'product'")
        .select(F.col("id").alias("product_tmpl_id"), "name", "categ_id", "uom_id")
    )
    categories = t["product_category"].select(F.col("id").alias("categ_id"), F.col("complete_name").alias("_category"))
    units = t["uom_uom"].select(F.col("id").alias("uom_id"), F.col("name").alias("_unit"))
    df = (
        products.join(templates, "product_tmpl_id")
        .join(categories, "categ_id", "left").join(units, "uom_id", "left")
        .withColumnRenamed("id", "product_id")
    )
    for measure in (on_hand(t), open_demand(t), consumed(t)):
        df = df.join(measure, "product_id", "left")
    held, wanted, used = (zero(F.col(c)) for c in ("on_hand", "open_demand", "consumed"))
    return df.filter((held != 0) | (wanted != 0) | (used != 0)).select(
        "product_id",
        F.coalesce("_category", F.lit(NO_CATEGORY)).alias("category"),
        localized("name").alias("product"),
        localized("_unit").alias("unit"),
        F.round(held, 2).alias("on_hand"),
        F.round(wanted, 2).alias("open_demand"),
        F.round(used, 2).alias("consumed"),
        F.round(held - used, 2).alias("available"),
    )


def inventory_totals(position: DataFrame) -> DataFrame:
    return position.agg(F.count(F.lit(1)).alias("products"),
                        *[F.sum(c).alias(f"total_{c}") for c in ("on_hand", "consumed", "available")])


# --- stock levels ----------------------------------------------------------------------------

def derive_quantities(df: DataFrame) -> DataFrame:
    """Fill available and value where the source has none: on hand − reserved, on hand × cost."""
    available = F.col("qty_on_hand") - F.col("qty_reserved")
    value = F.col("qty_on_hand") * F.col("unit_cost")

    def given(name: str) -> list[Column]:
        return [F.nullif(F.col(name), F.lit(0))] if name in df.columns else []

    return df.withColumns({
        "qty_available": F.coalesce(*given("qty_available"), available),
        "total_value": F.coalesce(*given("total_value"), value),
    })


def classify_levels(df: DataFrame) -> DataFrame:
    return df.withColumn("level", stock_level(F.col("qty_available"), F.col("reorder_point"), F.col("reorder_max")))


def inventory_levels(df: DataFrame) -> DataFrame:
    """Products with derived quantities and their stock level."""
    return classify_levels(derive_quantities(df))


def inventory_alerts(levels: DataFrame, key: str, limit: int = 8) -> DataFrame:
    """Critical products first, then low ones. Takes the unfiltered frame, as alerts ignore filters."""
    rank = F.when(F.col("level") == "critical", 0).when(F.col("level") == "low", 1)
    return levels.withColumn("alert_rank", rank).filter("alert_rank is not null").orderBy("alert_rank", key).limit(limit)


def level_distribution(levels: DataFrame) -> DataFrame:
    """Products per level; a level without products has no row."""
    return levels.groupBy("level").agg(F.count(F.lit(1)).alias("count"))


def inventory_kpis(levels: DataFrame, product: str = "product", category: str = "category") -> DataFrame:
    return levels.agg(
        F.countDistinct(product).alias("products"),
        F.countDistinct(category).alias("categories"),
        F.sum("total_value").alias("total_value"),
        F.count_if(F.col("level") == "critical").alias("critical"),
        F.count_if(F.col("level") == "low").alias("low"),
    )
