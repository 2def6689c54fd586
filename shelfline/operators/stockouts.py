"""Stock-out frequency by SKU, month and category, and the longest runs of stock-out days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.dates import weight
from shelfline.functions.numeric import mean, percent
from shelfline.plans.facts import days_in, days_with, inventory_by_sku, month_of, with_products
from shelfline.star import Star


def stockout_by_sku(star: Star) -> DataFrame:
    allowed = (1 - F.col("slg_target")) * 100
    return (
        with_products(
            inventory_by_sku(star.stock), star.products,
            "product_name", "category", "supplier_id", "slg_target", how="inner",
        )
        .withColumn("stockout_rate_pct", percent("stockout_days", "stock_rows"))
        .select(
            "sku_id", "product_name", "category", "supplier_id",
            F.col("stock_rows").alias("total_days"), "stockout_days", "stockout_rate_pct",
            (F.col("slg_target") * 100).alias("slg_target_pct"),
            F.round(allowed, 2).alias("allowed_stockout_pct"),
            F.when(F.col("stockout_rate_pct") > allowed, labels.EXCEEDS_ALLOWED_STOCKOUT)
            .otherwise(labels.WITHIN_TOLERANCE).alias("status"),
        )
        .orderBy(F.desc_nulls_first("stockout_days"), "sku_id")
    )


def stockout_by_month(star: Star) -> DataFrame:
    return (
        star.stock.groupBy(month_of("date").alias("month"))
        .agg(
            F.count_distinct("sku_id").alias("total_skus"),
            days_with(star.stock, "stockout_flag").alias("stockout_events"),
            days_in(star.stock).alias("total_sku_days"),
        )
        .withColumn("stockout_rate_pct", percent("stockout_events", "total_sku_days"))
        .orderBy(F.asc_nulls_last("month"))
    )


def stockout_by_category(star: Star) -> DataFrame:
    return (
        with_products(inventory_by_sku(star.stock), star.products, "category", how="inner")
        .groupBy("category")
        .agg(
            F.count("sku_id").alias("sku_count"),
            F.sum("stockout_days").alias("stockout_events"),
            F.sum("stock_rows").alias("total_sku_days"),
        )
        .withColumn("stockout_rate_pct", percent("stockout_events", "total_sku_days"))
        .orderBy(F.desc_nulls_first("stockout_rate_pct"), "category")
    )


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number)


def _bits(first: Column, count: Column) -> Column:
    return F.call_function("shiftleft", _bit(count) - 1, first)


def stockout_runs(inventory: DataFrame) -> DataFrame:
    """Unbroken runs of stock-out days per SKU: ``(sku_id, stockout_start, stockout_end, consecutive_days)``.

    A run is identified by how many days with stock come up to it; a day that has rows of both
    kinds starts a new one. One scan reduces a SKU's month to a summary: the days with stock as the
    bits of a number, and the days without stock, which are few, as a list. Summaries of months are
    joined by the days with stock before each month, so a run may go on over any number of months.
    """
    out, month, day = F.col("stockout_flag"), month_of("date").alias("month"), F.coalesce(F.dayofmonth("date"), F.lit(0))
    days = weight(inventory)
    months = inventory.groupBy("sku_id", month).agg(
        F.coalesce(F.bit_or(F.when(~out, _bits(day, days))), F.lit(0).cast("long")).alias("stocked"),
        F.flatten(F.collect_list(F.when(out, F.sequence(day, day + days - 1)))).alias("empty"),
    )
    earlier = Window.partitionBy("sku_id").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    placed = months.withColumn("before", F.coalesce(F.sum(F.bit_count("stocked")).over(earlier), F.lit(0)))
    days = placed.select("sku_id", "month", "stocked", "before", F.explode("empty").alias("day"))
    up_to = _bit(F.col("day").cast("int") + 1) - 1
    date = F.date_add("month", F.col("day").cast("int") - 1)
    return (
        days.select("sku_id", date.alias("date"), (F.col("before") + F.bit_count(F.col("stocked").bitwiseAND(up_to))).alias("run"))
        .groupBy("sku_id", "run")
        .agg(F.min("date").alias("stockout_start"), F.max("date").alias("stockout_end"), F.count(F.lit(1)).alias("consecutive_days"))
        .drop("run")
    )


def longest_stockouts(star: Star, min_days: int = 3, top: int = 50) -> DataFrame:
    runs = stockout_runs(star.stock).where(F.col("consecutive_days") >= min_days)
    return (
        runs.join(star.products.select("sku_id", "product_name", "category"), "sku_id")
        .select("sku_id", "product_name", "category", "stockout_start", "stockout_end", "consecutive_days")
        .orderBy(F.desc("consecutive_days"), F.asc("stockout_start"), "sku_id")
        .limit(top)
    )


def mean_stockout_days(star: Star) -> DataFrame:
    """Mean days without stock per SKU by category, counting days with exactly nothing on hand."""
    per_sku = (
        star.stock.where(F.col("sku_id").isNotNull())
        .groupBy("sku_id")
        .agg(days_in(star.stock).alias("rows"), days_with(star.stock, F.col("on_hand_qty") == 0).alias("days_out"))
    )
    return (
        with_products(per_sku, star.products, "category", how="inner")
        .groupBy("category")
        .agg(
            mean(F.sum("days_out"), F.count("days_out")).alias("avg_stockout_days"),
            F.sum("rows").alias("total_stockouts"),
        )
    )
