"""Writes the derived tables and every reporting mart, one table per report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators import alerts, forecasting, marts, segments, suppliers
from shelfline.sources.sinks import write_table
from shelfline.star import Star


def derive_tables(star: Star) -> dict[str, DataFrame]:
    """The tables later reports may build on, by file name."""
    return {
        "sku_clusters": segments.segment_skus(star).clusters,
        "forecasts": forecasting.forecast_skus(star),
        "alerts": alerts.detect_alerts(star),
    }


def mart_tables(star: Star) -> dict[str, DataFrame]:
    """Every mart by file name; those built on derived tables only where the star carries them."""
    tables = {
        "kpi_summary": marts.kpi_summary(star),
        "monthly_sales_trend": marts.monthly_sales(star),
        "daily_inventory_health": marts.daily_health(star),
        "daily_sales_by_category": marts.daily_sales_by_category(star),
        "monthly_sales_trend_by_category": marts.monthly_trend_by_category(star),
        "top_50_products": marts.top_products(star),
        "supplier_scorecard": suppliers.supplier_scorecard(star),
        "monthly_supplier_performance": suppliers.monthly_supplier_performance(star),
        "exception_dashboard": marts.exception_mart(star),
    }
    if star.forecasts is not None:
        tables["forecast_data"] = marts.forecast_mart(star)
    if star.clusters is not None:
        tables["sku_clusters"] = star.clusters
    return tables


def export(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> DataFrame:
    """Writes each table below ``folder`` and returns ``(table_name, rows)`` of what was written."""
    written = []
    for name, df in tables.items():
        path = f"{folder}/{name}{'.csv' if fmt == 'csv' else ''}"
        write_table(df, path, fmt)
        stored = df.sparkSession.read.schema(df.schema).load(path, format=fmt, **({"header": True} if fmt == "csv" else {}))
        written.append(stored.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
    return reduce(DataFrame.unionByName, written)
