"""Excess stock: by SKU, category and month, and the SKUs with too many weeks of supply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import mean, percent, quotient, wide
from shelfline.plans.facts import (
    inventory_by, inventory_by_sku, joined_rows, month_of, or_zero, stock_and_sales_by_sku, with_products,
)
from shelfline.star import Star


def days_of_supply() -> tuple[Column, Column]:
    """Mean stock over mean daily demand, as one exact fraction."""
    return wide("on_hand_sum") * wide("units_n"), wide("on_hand_n") * wide("units_sum")


def overstock_by_sku(star: Star) -> DataFrame:
    return (
        with_products(
            stock_and_sales_by_sku(star), star.products,
            "product_name", "category", "max_stock_level", "unit_price",
        )
        .select(
            "sku_id", "product_name", "category", "max_stock_level",
            quotient("on_hand_sum", "on_hand_n", 1).alias("avg_inventory"),
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            F.when(F.col("units_sum") > 0, quotient(*days_of_supply(), 1)).alias("days_of_supply"),
            or_zero("overstock_days").alias("overstock_days"),
            percent(or_zero("overstock_days"), joined_rows("stock_rows")).alias("overstock_rate_pct"),
            F.col("carrying_cost").alias("total_carrying_cost"),
            (F.col("unit_price").cast("double") * mean("on_hand_sum", "on_hand_n")).alias("avg_inventory_value"),
        )
        .orderBy(F.desc_nulls_first("total_carrying_cost"), "sku_id")
    )


def overstock_by_category(star: Star) -> DataFrame:
    return (
        with_products(inventory_by_sku(star.stock), star.products, "category")
        .groupBy("category")
        .agg(
            # One row per SKU at this point, so a plain count is the distinct count.
            F.count("sku_id").alias("sku_count"),
            quotient(F.sum("on_hand_sum"), F.sum("on_hand_n"), 1).alias("avg_inventory"),
            F.sum(or_zero("overstock_days")).alias("overstock_events"),
            percent(F.sum(or_zero("overstock_days")), F.sum(joined_rows("stock_rows"))).alias("overstock_rate_pct"),
            F.sum("carrying_cost").alias("total_carrying_cost"),
        )
        .orderBy(F.desc_nulls_first("total_carrying_cost"), "category")
    )


def excess_weeks_of_supply(star: Star, weeks: float = 8, top: int = 30) -> DataFrame:
    stock, demand = days_of_supply()
    return (
        with_products(
            stock_and_sales_by_sku(star), star.products,
            "product_name", "category", "unit_price",
        )
        .where((F.col("units_sum") > 0) & (stock > demand * F.lit(7 * weeks)))
        .select(
            "sku_id", "product_name", "category",
            quotient("on_hand_sum", "on_hand_n", 1).alias("avg_inventory"),
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            quotient(stock, demand * 7, 1).alias("weeks_of_supply"),
            F.col("carrying_cost").alias("total_carrying_cost"),
            (F.col("unit_price").cast("double") * mean("on_hand_sum", "on_hand_n")).alias("tied_up_capital"),
        )
        .orderBy(F.desc_nulls_first("weeks_of_supply"), "sku_id")
        .limit(top)
    )


def overstock_by_month(star: Star) -> DataFrame:
    return (
        inventory_by(star.stock, month_of("date").alias("month"))
        .select(
            "month",
            F.col("overstock_days").alias("overstock_events"),
            F.col("stock_rows").alias("total_sku_days"),
            percent("overstock_days", "stock_rows").alias("overstock_rate_pct"),
            F.col("carrying_cost").alias("monthly_carrying_cost"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )
