"""In-stock rates: by SKU, category and month, and the SKUs with the worst rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.numeric import percent
from shelfline.plans.facts import inventory_by, inventory_by_sku, month_of, with_products
from shelfline.star import Star


def _sku_rates(star: Star) -> DataFrame:
    return with_products(
        inventory_by_sku(star.stock), star.products, "product_name", "category", "slg_target", how="inner"
    ).withColumns(
        {
            "instock_rate_pct": percent("instock_days", "stock_rows"),
            "slg_target_pct": F.col("slg_target") * 100,
        }
    )


def instock_by_sku(star: Star) -> DataFrame:
    status = F.when(
        F.col("instock_rate_pct") >= F.col("slg_target_pct"), labels.MEETING_SLG
    ).otherwise(labels.BELOW_SLG)
    return (
        _sku_rates(star)
        .select(
            "sku_id", "product_name", "category",
            F.col("stock_rows").alias("total_days"), "instock_days", "instock_rate_pct",
            "slg_target_pct", status.alias("slg_status"),
        )
        .orderBy(F.asc_nulls_last("instock_rate_pct"), "sku_id")
    )


def instock_by_category(star: Star) -> DataFrame:
    return (
        with_products(inventory_by_sku(star.stock), star.products, "category", how="inner")
        .groupBy("category")
        .agg(F.sum("stock_rows").alias("total_days"), F.sum("instock_days").alias("instock_days"))
        .withColumn("instock_rate_pct", percent("instock_days", "total_days"))
        .orderBy(F.asc_nulls_last("instock_rate_pct"), "category")
    )


def instock_by_month(star: Star) -> DataFrame:
    return (
        inventory_by(star.stock, month_of("date").alias("month"))
        .select(
            "month", F.col("stock_rows").alias("total_days"), "instock_days",
            percent("instock_days", "stock_rows").alias("instock_rate_pct"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def worst_instock(star: Star, top: int = 20) -> DataFrame:
    return (
        _sku_rates(star)
        .select("sku_id", "product_name", "category", "instock_rate_pct", "stockout_days", "slg_target_pct")
        .orderBy(F.asc_nulls_last("instock_rate_pct"), "sku_id")
        .limit(top)
    )
