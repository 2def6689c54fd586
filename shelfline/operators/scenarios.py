"""Demand statistics per SKU, and what parameters would become if demand changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.numeric import half_even, mean, sample_deviation
from shelfline.plans.facts import sales_by_sku
from shelfline.star import Star


def demand_stats(star: Star) -> DataFrame:
    """Mean, deviation (0 for a single row) and total of units per SKU."""
    deviation = sample_deviation("units_sum", "units_squares", "units_n")
    return sales_by_sku(star.sales).select(
        "sku_id",
        mean("units_sum", "units_n").alias("avg_demand"),
        F.coalesce(deviation, F.lit(0.0)).alias("std_demand"),
        F.col("units_sum").alias("total_demand"),
    )


def _scaled(column: str, percent: float) -> Column:
    """A parameter changed by a percentage and cut to a whole number."""
    return (F.col(column).cast("double") * (1 + percent / 100)).cast("int")


def _demand_projection(percent: float) -> dict[str, Column]:
    return {
        "current_avg_demand": half_even(F.col("units_sum"), F.col("units_n"), 18, 2),
        "projected_avg_demand": half_even(
            F.col("units_sum") * round(10000 + percent * 100), F.col("units_n") * 10000, 18, 2
        ),
        "recommended_safety_stock": _scaled("safety_stock", percent),
        "recommended_reorder_point": _scaled("reorder_point", percent),
        "recommendation": F.lit(labels.RECOMMEND_INCREASE if percent > 0 else labels.RECOMMEND_REDUCE),
    }


def demand_change(star: Star, percent: float = 30) -> DataFrame:
    """Parameters scaled with demand; a projection of the demand statistics, no replay."""
    return (
        star.products.select("sku_id", "safety_stock", "reorder_point")
        .join(sales_by_sku(star.sales), "sku_id")
        .withColumns(_demand_projection(percent))
        .select(
            "sku_id", F.lit(f"Demand Change: {percent:+}%").alias("scenario"),
            "current_avg_demand", "projected_avg_demand",
            F.col("safety_stock").alias("current_safety_stock"), F.col("reorder_point").alias("current_reorder_point"),
            "recommended_safety_stock", "recommended_reorder_point", "recommendation",
        )
    )
