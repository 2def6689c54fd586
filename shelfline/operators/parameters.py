"""Are reorder points, min/max levels and order policies set well?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.numeric import percent, quotient, wide
from shelfline.plans.facts import inventory_by_sku, joined_rows, or_zero, sales_by_sku, with_products
from shelfline.star import Star


def _demand() -> tuple[Column, Column]:
    """Mean daily demand as a fraction: units, and rows they were sold on."""
    return wide("units_sum"), wide("units_n")


def reorder_point_evaluation(star: Star) -> DataFrame:
    units, rows = _demand()
    rop, lead, safety = wide("reorder_point"), wide("lead_time_days"), wide("safety_stock")
    needed = quotient(units * lead + safety * rows, rows, 0)
    status = (
        F.when(rop * rows < units * lead, labels.ROP_TOO_LOW)
        .when(rop * rows > units * lead * 2 + safety * rows, labels.ROP_TOO_HIGH)
        .otherwise(labels.ROP_ADEQUATE)
    )
    return (
        with_products(
            sales_by_sku(star.sales), star.products,
            "product_name", "category", "reorder_point", "safety_stock", "lead_time_days",
        )
        .select(
            "sku_id", "product_name", "category", "reorder_point", "safety_stock", "lead_time_days",
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            needed.alias("calculated_rop"),
            (F.col("reorder_point") - needed).alias("rop_difference"),
            status.alias("rop_status"),
        )
        .orderBy(F.abs("rop_difference").desc_nulls_first(), "sku_id")
    )


def minmax_evaluation(star: Star) -> DataFrame:
    """Means only, so pairing sales with stock days would not change any of them: the two facts
    are averaged separately."""
    units, rows = _demand()
    maximum, moq = wide("max_stock_level"), wide("min_order_qty")
    selling = F.col("units_sum") > 0
    max_status = (
        F.when(F.col("max_stock_level") < F.col("safety_stock") * 2, labels.MAX_TOO_LOW)
        .when(selling & (maximum * rows > units * 90), labels.MAX_TOO_HIGH)
        .otherwise(labels.MAX_ADEQUATE)
    )
    moq_status = (
        F.when(selling & (moq * rows < units * 3), labels.MOQ_TOO_LOW)
        .when(selling & (moq * rows > units * 30), labels.MOQ_TOO_HIGH)
        .otherwise(labels.MOQ_ADEQUATE)
    )
    return (
        with_products(
            inventory_by_sku(star.stock), star.products,
            "product_name", "category", "min_order_qty", "max_stock_level", "safety_stock",
        )
        .join(sales_by_sku(star.sales), "sku_id", "left")
        .select(
            "sku_id", "product_name", "category", "min_order_qty", "max_stock_level", "safety_stock",
            quotient("on_hand_sum", "on_hand_n", 1).alias("avg_inventory"),
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            F.when(selling, quotient(maximum * rows, units, 1)).alias("max_days_coverage"),
            max_status.alias("max_status"),
            moq_status.alias("moq_status"),
        )
        .orderBy("sku_id")
    )


def order_policy_effectiveness(star: Star) -> DataFrame:
    rows = F.sum(joined_rows("stock_rows"))
    return (
        with_products(inventory_by_sku(star.stock), star.products, "order_policy")
        .groupBy("order_policy")
        .agg(
            F.count("sku_id").alias("sku_count"),
            percent(F.sum(or_zero("instock_days")), rows).alias("avg_instock_rate"),
            percent(F.sum(or_zero("stockout_days")), rows).alias("avg_stockout_rate"),
            percent(F.sum(or_zero("overstock_days")), rows).alias("avg_overstock_rate"),
            F.sum("carrying_cost").alias("total_carrying_cost"),
        )
        .orderBy(F.desc_nulls_first("avg_instock_rate"), "order_policy")
    )


def parameters_to_adjust(star: Star) -> DataFrame:
    too_empty = F.col("stockout_days") > labels.HIGH_STOCKOUT_DAYS
    too_full = F.col("overstock_days") > labels.HIGH_OVERSTOCK_DAYS
    return (
        with_products(inventory_by_sku(star.stock), star.products, "product_name", "category", "order_policy")
        .where(too_empty | too_full)
        .select(
            "sku_id", "product_name", "category", "order_policy",
            percent("stockout_days", "stock_rows").alias("stockout_rate"),
            percent("overstock_days", "stock_rows").alias("overstock_rate"),
            F.when(too_empty, labels.ADJUST_UP)
            .when(too_full, labels.ADJUST_DOWN)
            .otherwise(labels.ADJUST_NONE)
            .alias("recommended_action"),
        )
        .orderBy(F.desc_nulls_first("stockout_rate"), F.desc_nulls_first("overstock_rate"), "sku_id")
    )
