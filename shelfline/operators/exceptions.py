"""Exception flags, priority score and recommended action per SKU; top list; counts by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.numeric import percent
from shelfline.plans.facts import (
    inventory_by_sku, joined_rows, or_zero, sales_by_sku, stock_and_sales_by_sku, with_products,
)
from shelfline.star import Star

def _below_slg() -> Column:
    return F.col("instock_rate") < F.col("slg_target") * 100


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _sku_exceptions(star: Star, *columns: str) -> DataFrame:
    return with_products(inventory_by_sku(star.stock), star.products, "slg_target", *columns).withColumn(
        "instock_rate", percent("instock_days", "stock_rows")
    )


def exception_summary(star: Star) -> DataFrame:
    """All stock measures of a SKU come from one pass over the inventory; a product without
    inventory has NULL rates and a NULL score."""
    stockout_rate = percent("stockout_days", "stock_rows")
    overstock_rate = percent("overstock_days", "stock_rows")
    score = (
        F.when(_below_slg(), labels.PRIORITY_BELOW_SLG).otherwise(0)
        + F.col("stockout_rate") * 2
        + F.col("overstock_rate") / 2
        + F.when(F.col("total_revenue") > labels.HIGH_REVENUE, labels.PRIORITY_HIGH_REVENUE).otherwise(0)
    )
    action = (
        F.when(F.col("stockout_days") > labels.CRITICAL_STOCKOUT_DAYS, labels.ACTION_CRITICAL)
        .when(F.col("stockout_days") > labels.HIGH_STOCKOUT_DAYS, labels.ACTION_HIGH)
        .when(_below_slg(), labels.ACTION_MEDIUM)
        .when(F.col("overstock_days") > labels.SEVERE_OVERSTOCK_DAYS, labels.ACTION_LOW_MAX)
        .when(F.col("overstock_days") > labels.HIGH_OVERSTOCK_DAYS, labels.ACTION_LOW_FREQUENCY)
        .otherwise(labels.ACTION_OK)
    )
    return (
        _sku_exceptions(star, "product_name", "category", "supplier_id")
        .join(sales_by_sku(star.sales).select("sku_id", F.col("revenue_sum").alias("total_revenue")), "sku_id", "left")
        .withColumns({"stockout_rate": stockout_rate, "overstock_rate": overstock_rate})
        .select(
            "sku_id", "product_name", "category", "supplier_id",
            (F.col("slg_target") * 100).alias("slg_target_pct"),
            "instock_rate", "stockout_days", "stockout_rate", "overstock_days", "overstock_rate",
            F.col("carrying_cost").alias("total_carrying_cost"), "total_revenue",
            _flag(_below_slg()).alias("below_slg_flag"),
            _flag(F.col("stockout_days") > labels.HIGH_STOCKOUT_DAYS).alias("high_stockout_flag"),
            _flag(F.col("overstock_days") > labels.HIGH_OVERSTOCK_DAYS).alias("high_overstock_flag"),
            F.round(score, 1).alias("priority_score"),
            action.alias("recommended_action"),
        )
        .orderBy(F.desc_nulls_first("priority_score"), "sku_id")
    )


def top_exceptions(star: Star, top: int = 20) -> DataFrame:
    target = F.col("slg_target") * 100
    kind = (
        F.when(F.col("stockout_days") > labels.CRITICAL_STOCKOUT_DAYS, labels.TYPE_STOCKOUT_CRISIS)
        .when(_below_slg(), labels.TYPE_BELOW_SLG)
        .when(F.col("overstock_days") > labels.SEVERE_OVERSTOCK_DAYS, labels.TYPE_SEVERE_OVERSTOCK)
        .otherwise(labels.TYPE_REVIEW)
    )
    return (
        with_products(
            stock_and_sales_by_sku(star), star.products,
            "product_name", "category", "slg_target",
        )
        .withColumns(
            {
                "instock_rate": percent(or_zero("instock_days"), joined_rows("stock_rows")),
                "stockout_days": or_zero("stockout_days"),
                "overstock_days": or_zero("overstock_days"),
            }
        )
        .where(
            (F.col("stockout_days") > labels.HIGH_STOCKOUT_DAYS)
            | _below_slg()
            | (F.col("overstock_days") > labels.HIGH_OVERSTOCK_DAYS)
        )
        .select(
            "sku_id", "product_name", "category", "instock_rate", target.alias("slg_target_pct"),
            "stockout_days", "overstock_days", F.col("revenue_sum").alias("total_revenue"),
            kind.alias("exception_type"),
        )
        .orderBy(
            F.desc_nulls_first("stockout_days"),
            F.desc_nulls_first(F.col("slg_target_pct") - F.col("instock_rate")),
            "sku_id",
        )
        .limit(top)
    )


def exception_counts_by_category(star: Star) -> DataFrame:
    return (
        _sku_exceptions(star, "category")
        .groupBy("category")
        .agg(
            F.count("sku_id").alias("total_skus"),
            F.count_if(_below_slg()).alias("below_slg_count"),
            F.count_if(F.col("stockout_days") > labels.HIGH_STOCKOUT_DAYS).alias("high_stockout_count"),
            F.count_if(F.col("overstock_days") > labels.HIGH_OVERSTOCK_DAYS).alias("high_overstock_count"),
        )
        .orderBy(F.desc_nulls_first("high_stockout_count"), "category")
    )
