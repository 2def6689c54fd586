"""Inventory turns.

The per-SKU and per-category reports pair every sale of a SKU with every one of its stock days,
so their unit totals grow with the number of stock days. ``mode="all_pairs"`` (the default)
gives exactly those numbers without building the pairs; ``mode="grain_safe"`` counts each sale
and each stock day once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import mean, quotient, wide
from shelfline.plans.facts import (
    all_pairs_measures, inventory_by_sku, month_of, sales_by_sku, stock_with_day_sales, with_products,
)
from shelfline.star import Star


def _measures(star: Star, mode: str, how: str = "left") -> DataFrame:
    if mode == "all_pairs":
        return all_pairs_measures(star.stock, star.sales, how)
    if mode != "grain_safe":
        raise ValueError(f"unknown mode {mode!r}: use 'all_pairs' or 'grain_safe'")
    joined = sales_by_sku(star.sales).join(
        inventory_by_sku(star.stock), "sku_id", "full" if how == "left" else "inner"
    )
    return joined.select(
        "sku_id",
        wide("units_sum").alias("pair_units"),
        wide("on_hand_sum").alias("pair_on_hand"),
        wide("on_hand_n").alias("pair_on_hand_n"),
    )


def _turns(units: str = "pair_units", stock: str = "pair_on_hand", stock_n: str = "pair_on_hand_n") -> Column:
    """Units over mean stock, 2 places; 0 when there is no stock, NULL when there are no sales."""
    return F.when(F.col(stock) > 0, quotient(wide(units) * wide(stock_n), stock, 2)).otherwise(0)


def _sku_turns(star: Star, mode: str, *columns: str) -> DataFrame:
    return with_products(_measures(star, mode), star.products, "product_name", "category", *columns).withColumns(
        {
            "total_units_sold": F.col("pair_units"),
            "avg_inventory": quotient("pair_on_hand", "pair_on_hand_n", 1),
            "inventory_turns": _turns(),
        }
    )


def turns_by_sku(star: Star, mode: str = "all_pairs") -> DataFrame:
    days = F.when(
        (F.col("pair_on_hand") > 0) & (F.col("pair_units") > 0),
        quotient(wide("pair_on_hand") * 365, wide("pair_on_hand_n") * wide("pair_units"), 1),
    )
    return (
        _sku_turns(star, mode, "unit_price")
        .select(
            "sku_id", "product_name", "category", "unit_price", "total_units_sold", "avg_inventory",
            "inventory_turns", days.alias("days_to_turn"),
        )
        .orderBy(F.desc_nulls_first("inventory_turns"), "sku_id")
    )


def turns_by_category(star: Star, mode: str = "all_pairs") -> DataFrame:
    return (
        with_products(_measures(star, mode), star.products, "category")
        .groupBy("category")
        .agg(F.sum("pair_units").alias("pair_units"), F.sum("pair_on_hand").alias("pair_on_hand"), F.sum("pair_on_hand_n").alias("pair_on_hand_n"))
        .select(
            "category",
            F.col("pair_units").alias("total_units_sold"),
            quotient("pair_on_hand", "pair_on_hand_n", 1).alias("avg_inventory"),
            _turns().alias("inventory_turns"),
        )
        .orderBy(F.desc_nulls_first("inventory_turns"), "category")
    )


def turns_by_month(star: Star) -> DataFrame:
    """Sales joined to stock on SKU and day, sales reduced to one row per SKU-day first."""
    joined = stock_with_day_sales(star).where("sales_rows is not null")
    stock = F.col("on_hand_qty")
    return (
        joined.groupBy(month_of("date").alias("month"))
        .agg(
            F.sum("units_sum").alias("monthly_sales"),
            F.sum(stock * F.col("sales_rows")).alias("stock"),
            F.sum(F.when(stock.isNotNull(), F.col("sales_rows")).otherwise(0)).alias("stock_n"),
        )
        .select(
            "month",
            "monthly_sales",
            quotient("stock", "stock_n", 1).alias("avg_inventory"),
            _turns("monthly_sales", "stock", "stock_n").alias("monthly_turns"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def slow_movers(star: Star, top: int = 20, mode: str = "all_pairs") -> DataFrame:
    """Lowest turns among stocked SKUs; a stocked SKU without any sale has NULL turns and sorts last."""
    return (
        _sku_turns(star, mode)
        .where("pair_on_hand > 0")
        .select("sku_id", "product_name", "category", "total_units_sold", "avg_inventory", "inventory_turns")
        .orderBy(F.asc_nulls_last("inventory_turns"), "sku_id")
        .limit(top)
    )


def category_turns(star: Star, mode: str = "all_pairs") -> DataFrame:
    """Unrounded turns by category over SKUs that have both sales and stock."""
    return (
        with_products(_measures(star, mode, how="inner"), star.products, "category", how="inner")
        .groupBy("category")
        .agg(F.sum("pair_units").alias("units"), F.sum("pair_on_hand").alias("stock"), F.sum("pair_on_hand_n").alias("stock_n"))
        .select("category", F.try_divide(F.col("units").cast("double"), mean("stock", "stock_n")).alias("inventory_turns"))
        .orderBy(F.desc_nulls_first("inventory_turns"), "category")
    )
