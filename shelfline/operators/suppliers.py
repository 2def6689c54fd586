"""Supplier lead time, fill and on-time performance, reliability scores and late deliveries.

There are two reliability scores on purpose: ``reliability_score`` keeps suppliers without
orders, ``supplier_scorecard`` does not; a missing deviation also counts differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.numeric import mean, percent, quotient, sample_deviation
from shelfline.plans.facts import joined_rows, month_of, or_zero, orders_by
from shelfline.star import Star


def _by_supplier(star: Star) -> DataFrame:
    return orders_by(star.orders.where(F.col("supplier_id").isNotNull()), "supplier_id")


def _lead_deviation() -> Column:
    return sample_deviation("lead_sum", "lead_squares", "lead_n")


def _on_time_percent(digits: int) -> Column:
    return percent(or_zero("on_time_rows"), joined_rows("order_rows"), digits)


def supplier_performance(star: Star) -> DataFrame:
    """A supplier without orders shows one order and an on-time rate of 0."""
    return (
        star.suppliers.join(_by_supplier(star), "supplier_id", "left")
        .select(
            "supplier_id", "supplier_name",
            F.col("avg_lead_time").alias("expected_lead_time"),
            F.col("lead_time_variance").alias("expected_variance"),
            quotient("lead_sum", "lead_n", 1).alias("actual_avg_lead_time"),
            F.round(_lead_deviation(), 2).alias("actual_lead_time_stddev"),
            F.col("fill_rate").alias("expected_fill_rate"),
            quotient("fill_sum", "fill_n", 4, scale=4).alias("actual_fill_rate"),
            F.col("on_time_delivery_rate").alias("expected_otd"),
            _on_time_percent(2).alias("actual_otd_pct"),
            joined_rows("order_rows").alias("total_orders"),
        )
        .orderBy(F.desc_nulls_first("actual_otd_pct"), "supplier_id")
    )


def supplier_by_month(star: Star) -> DataFrame:
    return (
        orders_by(star.orders, "supplier_id", month_of("order_date").alias("month"))
        .join(star.suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .select(
            "supplier_id", "supplier_name", "month",
            F.col("order_rows").alias("orders"),
            quotient("lead_sum", "lead_n", 1).alias("avg_lead_time"),
            quotient("fill_sum", "fill_n", 4, scale=4).alias("avg_fill_rate"),
            percent("on_time_rows", "order_rows").alias("otd_pct"),
        )
        .orderBy("supplier_id", "month")
    )


def late_deliveries(star: Star, top: int = 50) -> DataFrame:
    """The latest deliveries; only rows that have a supplier and a product count. Late rows meet
    the keys of both, the top ones are taken, and only those fetch the names."""
    latest = (
        star.orders.where(F.col("actual_delivery_date") > F.col("expected_delivery_date"))
        .join(star.suppliers.select("supplier_id"), "supplier_id", "left_semi")
        .join(star.products.select("sku_id"), "sku_id", "left_semi")
        .orderBy(F.desc(F.datediff("actual_delivery_date", "expected_delivery_date")), "order_id")
        .limit(top)
    )
    return (
        latest.join(star.suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .join(star.products.select("sku_id", "product_name"), "sku_id")
        .select(
            "supplier_id", "supplier_name", "order_id", "sku_id", "product_name", "order_date",
            "expected_delivery_date", "actual_delivery_date",
            F.datediff("actual_delivery_date", "expected_delivery_date").alias("days_late"),
            "lead_time_actual",
        )
        .orderBy(F.desc("days_late"), "order_id")
        .limit(top)
    )


def reliability_score(star: Star) -> DataFrame:
    spread = _lead_deviation() / F.nullif(mean("lead_sum", "lead_n"), F.lit(0.0)) * 100
    on_time = mean(or_zero("on_time_rows") * 100, joined_rows("order_rows"))
    score = (
        mean("fill_sum", "fill_n") * 100 * 0.3
        + on_time * 0.4
        + (100 - F.coalesce(spread, F.lit(0.0))) * 0.3
    )
    return (
        star.suppliers.select("supplier_id", "supplier_name")
        .join(_by_supplier(star), "supplier_id", "left")
        .select(
            "supplier_id", "supplier_name",
            quotient(F.col("fill_sum") * 100, "fill_n", 1, scale=4).alias("fill_rate_score"),
            _on_time_percent(1).alias("otd_score"),
            F.round(100 - spread, 1).alias("consistency_score"),
            F.round(score, 1).alias("overall_reliability_score"),
        )
        .orderBy(F.desc_nulls_first("overall_reliability_score"), "supplier_id")
    )


def delivery_scorecard(star: Star) -> DataFrame:
    """Orders, mean delay (early deliveries count as negative) and on-time fraction by supplier name."""
    return (
        _by_supplier(star)
        .join(star.suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .groupBy("supplier_name")
        .agg(
            F.sum("order_ids").alias("total_orders"),
            mean(F.sum("late_sum"), F.sum("late_n")).alias("avg_delay_days"),
            mean(F.sum("on_time_rows"), F.sum("order_rows")).alias("on_time_rate"),
        )
        .orderBy(F.desc_nulls_first("on_time_rate"), "supplier_name")
    )


def supplier_scorecard(star: Star) -> DataFrame:
    """Scorecard of the suppliers that have orders."""
    lead, on_time = mean("lead_sum", "lead_n"), mean("on_time_rows", "order_rows")
    steadiness = 1 - F.coalesce(_lead_deviation(), F.lit(0.0)) / F.when(lead == 0, 1.0).otherwise(lead)
    fill = mean("fill_sum", "fill_n")
    return (
        _by_supplier(star)
        .join(star.suppliers, "supplier_id")
        .select(
            "supplier_id",
            F.col("order_ids").alias("total_orders"),
            F.col("order_qty").alias("total_qty"),
            lead.alias("actual_avg_lead_time"),
            _lead_deviation().alias("lead_time_std"),
            fill.alias("avg_fill_rate"),
            on_time.alias("on_time_rate"),
            mean("late_sum", "late_n").alias("avg_days_late"),
            "supplier_name", "avg_lead_time", "lead_time_variance", "fill_rate",
            "on_time_delivery_rate", "min_order_value",
            F.bround(fill * 30 + on_time * 40 + steadiness * 30, 1).alias("reliability_score"),
        )
    )


def monthly_supplier_performance(star: Star) -> DataFrame:
    return orders_by(
        star.orders, F.date_format("order_date", "yyyy-MM").alias("month"), "supplier_id"
    ).select(
        "month", "supplier_id",
        F.col("order_ids").alias("orders"),
        mean("on_time_rows", "order_rows").alias("on_time_rate"),
        mean("fill_sum", "fill_n").alias("fill_rate"),
    )


def contract_rates(star: Star) -> DataFrame:
    """Agreed fill and on-time rates in percent, and the agreed lead time."""
    return star.suppliers.select(
        "supplier_name",
        (F.col("fill_rate") * 100).alias("fill_rate_pct"),
        (F.col("on_time_delivery_rate") * 100).alias("on_time_rate_pct"),
        F.col("avg_lead_time").alias("lead_time"),
    )
