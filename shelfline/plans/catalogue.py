"""The named reports: ``name -> function(star) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.dates import last_day, since
from shelfline.operators import (
    alerts, exceptions, forecasting, ledger, marts, overstock, parameters, quality, safety_stock, scenarios,
    segments, service_level, stockouts, suppliers, turns,
)
from shelfline.star import Star

Report = Callable[[Star], DataFrame]

INVENTORY_REPORTS: dict[str, Report] = {
    "instock_by_sku": service_level.instock_by_sku,
    "instock_by_category": service_level.instock_by_category,
    "instock_by_month": service_level.instock_by_month,
    "worst_instock": service_level.worst_instock,
    "overstock_by_sku": overstock.overstock_by_sku,
    "overstock_by_category": overstock.overstock_by_category,
    "excess_weeks_of_supply": lambda s: overstock.excess_weeks_of_supply(s, weeks=0.75),
    "overstock_by_month": overstock.overstock_by_month,
    "exception_summary": exceptions.exception_summary,
    "top_exceptions": exceptions.top_exceptions,
    "exception_counts_by_category": exceptions.exception_counts_by_category,
    "turns_by_sku": turns.turns_by_sku,
    "turns_by_category": turns.turns_by_category,
    "turns_by_month": turns.turns_by_month,
    "slow_movers": turns.slow_movers,
    "category_turns": turns.category_turns,
    "stockout_by_sku": stockouts.stockout_by_sku,
    "stockout_by_month": stockouts.stockout_by_month,
    "stockout_by_category": stockouts.stockout_by_category,
    "longest_stockouts": stockouts.longest_stockouts,
    "mean_stockout_days": stockouts.mean_stockout_days,
    "supplier_performance": suppliers.supplier_performance,
    "supplier_by_month": suppliers.supplier_by_month,
    "late_deliveries": suppliers.late_deliveries,
    "reliability_score": suppliers.reliability_score,
    "delivery_scorecard": suppliers.delivery_scorecard,
    "reorder_point_evaluation": parameters.reorder_point_evaluation,
    "minmax_evaluation": parameters.minmax_evaluation,
    "order_policy_effectiveness": parameters.order_policy_effectiveness,
    "parameters_to_adjust": parameters.parameters_to_adjust,
    "safety_stock_by_sku": safety_stock.safety_stock_by_sku,
    "inadequate_safety_stock": safety_stock.inadequate_safety_stock,
    "excess_safety_stock": safety_stock.excess_safety_stock,
}


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals: beyond them, sums of doubles depend on the order of the rows."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _alerts(star: Star) -> DataFrame:
    """All alerts, stamped with the last inventory day."""
    return alerts.detect_alerts(star, as_of=last_day(star.stock).cast("timestamp"))


def _with_alerts(star: Star) -> Star:
    return star.with_derived(alerts=_alerts(star))


def _quality(star: Star) -> DataFrame:
    """Sales are expected to cover the years of the orders."""
    years = star.orders.agg(F.min(F.year("order_date")).alias("first"), F.max(F.year("order_date")).alias("last")).first()
    names = ("products", "suppliers", "sales", "inventory", "orders")
    return quality.validate({name: getattr(star, name) for name in names}, years=(years["first"], years["last"]))


def _demand_spikes(star: Star) -> DataFrame:
    """Spikes of the last 60 sales days, half a deviation above the mean: at brand grain few days
    lie further out."""
    last = last_day(star.sales)
    limits = alerts.Thresholds(demand_spike_std=0.5, lookback_days=60)
    return alerts.demand_spike_alerts(since(star.sales, F.date_sub(last, limits.lookback_days)), star.products, limits)


LEDGER_REPORTS: dict[str, Report] = {
    "ledger_rollup": lambda s: ledger.ledger_rollup(s.stock),
    "demand_on_calendar": lambda s: ledger.demand_on_calendar(s.products, s.sales, s.calendar)
    .groupBy("date").agg(F.sum("units_sold").alias("units_sold"), F.count("sku_id").alias("skus")),
    "triggered_orders_rollup": lambda s: ledger.triggered_orders_rollup(
        ledger.triggered_orders(s.stock, s.products, s.suppliers)
    ),
}

MART_REPORTS: dict[str, Report] = {
    "kpi_summary": marts.kpi_summary,
    "kpi_summary_with_value": lambda s: marts.kpi_summary(s, include_inventory_value=True),
    "kpi_strip": lambda s: marts.kpi_strip(s, _alerts(s)),
    "monthly_sales": marts.monthly_sales,
    "inventory_health_rollup": marts.inventory_health_rollup,
    "daily_health": marts.daily_health,
    "sales_detail": marts.sales_detail,
    "daily_sales_by_category": marts.daily_sales_by_category,
    "monthly_trend_by_category": marts.monthly_trend_by_category,
    "top_products": marts.top_products,
    "top_ten_products": lambda s: marts.top_products(s, 10),
    "supplier_scorecard": suppliers.supplier_scorecard,
    "monthly_supplier_performance": suppliers.monthly_supplier_performance,
    "contract_rates": suppliers.contract_rates,
    "exception_mart": lambda s: marts.exception_mart(_with_alerts(s)),
    "exception_mart_without_alerts": marts.exception_mart,
    "exception_mart_empty_alerts": lambda s: marts.exception_mart(s.with_derived(alerts=_alerts(s).limit(0))),
    "category_totals": marts.category_totals,
    "monthly_instock_by_category": marts.monthly_instock_by_category,
    "daily_instock_by_category": marts.daily_instock_by_category,
    "stockout_heatmap": marts.stockout_heatmap,
    "alert_counts": lambda s: marts.alert_counts(_alerts(s)),
    "data_quality": _quality,
}

ALERT_REPORTS: dict[str, Report] = {
    "alerts": _alerts,
    "consecutive_stockout_alerts": lambda s: alerts.stockout_alerts(s.stock, s.products, consecutive=True),
    "alert_summary": lambda s: alerts.alert_summary(_alerts(s)),
    "urgent_alerts": lambda s: alerts.urgent_alerts(_alerts(s)),
}

SEGMENT_REPORTS: dict[str, Report] = {
    "sku_features": segments.sku_features,
    "scaled_features": lambda s: _rounded(
        segments.scale_features(segments.sku_features(s)), *[f"z_{c}" for c in labels.CLUSTER_FEATURES]
    ),
    "revenue_quartiles": segments.revenue_quartiles,
    "choose_k": segments.choose_k,
    "silhouettes_of_dealt": segments.silhouettes_of_dealt,
}

# Reports on a star that carries a segmentation.
CLUSTER_REPORTS: dict[str, Report] = {
    "segment_labels": lambda s: s.clusters,
    "cluster_display": lambda s: marts.cluster_display(s.clusters),
    "cluster_summary": lambda s: segments.cluster_summary(s.clusters),
    "segment_descriptions": lambda s: segments.describe_segments(s.clusters),
}

SCENARIO_REPORTS: dict[str, Report] = {
    "demand_stats": scenarios.demand_stats,
    "demand_change": scenarios.demand_change,
}

# Reports that need dense daily series; they run on sales at a coarser grain.
SERIES_REPORTS: dict[str, Report] = {
    "demand_spikes": _demand_spikes,
    "filled_series": lambda s: forecasting.filled_series(s.sales),
    "observed_series": lambda s: forecasting.observed_series(s.sales),
    "model_evaluation": lambda s: _rounded(forecasting.evaluate_models(s), "mae", "rmse"),
    "best_models": lambda s: _rounded(forecasting.best_models(s), "model_mae"),
    "forecasts": forecasting.forecast_skus,
    "forecasts_with_gaps_filled": lambda s: forecasting.forecast_skus(s, fill_gaps=True),
    "model_usage": lambda s: forecasting.model_usage(forecasting.forecast_skus(s)),
    "forecast_summaries": forecasting.forecast_summaries,
}

_ALL = INVENTORY_REPORTS | MART_REPORTS | ALERT_REPORTS | SEGMENT_REPORTS | SCENARIO_REPORTS

# Reports that read sales, orders and dimensions only, and those that read the inventory.
FLOW_REPORTS: dict[str, Report] = {
    name: _ALL[name]
    for name in (
        "supplier_performance", "supplier_by_month", "late_deliveries", "reliability_score", "delivery_scorecard",
        "reorder_point_evaluation", "monthly_sales", "sales_detail", "daily_sales_by_category",
        "monthly_trend_by_category", "top_products", "top_ten_products", "supplier_scorecard",
        "monthly_supplier_performance", "contract_rates", "category_totals", "revenue_quartiles", "demand_stats",
        "demand_change",
    )
}
STOCK_REPORTS: dict[str, Report] = {name: report for name, report in _ALL.items() if name not in FLOW_REPORTS}
