"""Is the safety stock too low (stock-outs) or too high (excess stock)?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.numeric import percent, quotient, sample_deviation, wide
from shelfline.operators.overstock import days_of_supply
from shelfline.plans.facts import joined_rows, or_zero, stock_and_sales_by_sku, with_products
from shelfline.star import Star


def safety_stock_by_sku(star: Star) -> DataFrame:
    status = (
        F.when(F.col("stockout_days") > labels.HIGH_STOCKOUT_DAYS, labels.SAFETY_TOO_LOW)
        .when(
            wide("on_hand_sum") * 2 > wide("max_stock_level") * wide("on_hand_n") * 3, labels.SAFETY_TOO_HIGH
        )
        .otherwise(labels.SAFETY_ADEQUATE)
    )
    coverage = quotient(wide("safety_stock") * wide("units_n"), wide("units_sum"), 1)
    return (
        with_products(
            stock_and_sales_by_sku(star), star.products,
            "product_name", "category", "safety_stock", "reorder_point", "max_stock_level",
        )
        .select(
            "sku_id", "product_name", "category", "safety_stock", "reorder_point",
            quotient("on_hand_sum", "on_hand_n", 1).alias("avg_inventory"),
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            or_zero("stockout_days").alias("stockout_days"),
            percent(or_zero("stockout_days"), joined_rows("stock_rows")).alias("stockout_rate_pct"),
            status.alias("safety_stock_status"),
            F.when(F.col("units_sum") > 0, coverage).alias("safety_stock_days_coverage"),
        )
        .orderBy(F.desc_nulls_first("stockout_days"), "sku_id")
    )


def inadequate_safety_stock(star: Star, min_days: int = 20, top: int = 30) -> DataFrame:
    deviation = sample_deviation("units_sum", "units_squares", "units_n")
    return (
        with_products(
            stock_and_sales_by_sku(star), star.products,
            "product_name", "category", "safety_stock", "lead_time_days",
        )
        .where(F.col("stockout_days") > min_days)
        .select(
            "sku_id", "product_name", "category",
            F.col("safety_stock").alias("current_safety_stock"),
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            "lead_time_days", "stockout_days",
            percent("stockout_days", "stock_rows").alias("stockout_rate_pct"),
            F.round(deviation * 2 * F.sqrt("lead_time_days"), 0).alias("recommended_safety_stock"),
        )
        .orderBy(F.desc_nulls_first("stockout_days"), "sku_id")
        .limit(top)
    )


def excess_safety_stock(star: Star, top: int = 30) -> DataFrame:
    return (
        with_products(
            stock_and_sales_by_sku(star), star.products,
            "product_name", "category", "safety_stock", "max_stock_level",
        )
        .where(wide("on_hand_sum") > wide("max_stock_level") * wide("on_hand_n"))
        .select(
            "sku_id", "product_name", "category",
            F.col("safety_stock").alias("current_safety_stock"),
            quotient("on_hand_sum", "on_hand_n", 1).alias("avg_inventory"),
            "max_stock_level",
            quotient("units_sum", "units_n", 1).alias("avg_daily_demand"),
            F.when(F.col("units_sum") > 0, quotient(*days_of_supply(), 1)).alias("days_of_supply"),
            F.col("carrying_cost").alias("total_carrying_cost"),
        )
        .orderBy(F.desc_nulls_first("total_carrying_cost"), "sku_id")
        .limit(top)
    )
