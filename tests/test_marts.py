from decimal import Decimal

import pytest
from conftest import order, product, sale, snapshot, supplier

from pyspark.sql import functions as F

from shelfline.operators import marts, segments, suppliers
from shelfline.operators.alerts import detect_alerts


@pytest.fixture
def star(make_star):
    return make_star(
        products=[product("a"), product("b", category="c2", safety_stock=0)],
        suppliers=[supplier("s1")],
        sales=[sale("a", 0, 4, "40.00"), sale("a", 40, 1, "10.00"), sale("b", 40, 5, "90.00"), sale("ghost", 40, 9, "1.00")],
        inventory=[snapshot("a", 0, 0), snapshot("a", 40, 6), snapshot("b", 40, 41), snapshot("ghost", 40, 0)],
        orders=[order("o1", 0, 0), order("o2", 40, 2)],
    )


def test_kpis(star):
    values = {r.metric: (r.value, r.format) for r in marts.kpi_summary(star, include_inventory_value=True).collect()}
    assert values["Total Revenue"] == (141.0, "currency") and values["SKU Count"] == (2.0, "number")
    assert values["In-Stock Rate"] == (50.0, "percent") and values["Overstock Rate"][0] == 25.0
    assert values["Average Inventory Value"][0] == pytest.approx(470 / 3)
    strip = marts.kpi_strip(star, detect_alerts(star)).first()
    assert (strip.total_units, strip.critical_alerts, strip.instock_light, strip.stockout_light) == (19, 0, "red", "red")


def test_health_status_uses_the_products_safety_stock(star):
    rows = {(r.sku_id, r.date.month): r for r in marts.inventory_health(star).collect()}
    assert {k: r.health_status for k, r in rows.items()} == {
        ("a", 1): "Stockout", ("a", 2): "Low Stock", ("b", 2): "Overstock"
    }
    assert rows["b", 2].safety_stock_pct == 4100.0  # a safety stock of 0 counts as 1


def test_heatmap_fills_missing_months(star):
    cells = {(r.category, r.month): r.stockout_days for r in marts.stockout_heatmap(star).collect()}
    assert cells == {("c1", "2024-01"): 1, ("c1", "2024-02"): 0, ("c2", "2024-01"): 0, ("c2", "2024-02"): 0}
    wide = {r.category: list(r)[1:] for r in marts.months_as_columns(marts.stockout_heatmap(star)).collect()}
    assert wide == {"c1": [1, 0], "c2": [0, 0]}


def test_heatmap_follows_the_inventory(star):
    """No month is written down anywhere: stock-outs two years earlier show as well."""
    early = star.with_derived(inventory=star.inventory.withColumn("date", F.add_months("date", -24)))
    cells = {(r.category, r.month): r.stockout_days for r in marts.stockout_heatmap(early).collect()}
    assert sum(cells.values()) == 1 and cells["c1", "2022-01"] == 1


def test_empty_alert_table_counts_as_none(star):
    empty = star.with_derived(alerts=detect_alerts(star).limit(0))
    assert marts.exception_mart(empty).collect() == marts.exception_mart(star).collect() != []


def test_category_comes_from_the_product(star):
    got = {(r.month, r.category): r.active_skus for r in marts.monthly_trend_by_category(star).collect()}
    assert got == {("2024-01", "c1"): 1, ("2024-02", "c1"): 1, ("2024-02", "c2"): 1}
    detail = marts.sales_detail(star).where("sku_id = 'b'").first()
    assert (detail.category, detail.week, detail.day_of_week) == ("c2", 6, "Saturday")


def test_exception_mart_with_and_without_alerts(star):
    fallback = marts.exception_mart(star).collect()
    assert [(r.sku_id, r.exception_type) for r in fallback] == [("a", "Low Stock"), ("b", "Overstock")] or {
        (r.sku_id, r.exception_type) for r in fallback
    } == {("a", "Low Stock"), ("b", "Overstock")}
    found = detect_alerts(star)
    assert marts.exception_mart(star.with_derived(alerts=found)).count() == found.count()


def test_forecast_mart(spark, star):
    assert marts.forecast_mart(star) is None
    forecasts = spark.createDataFrame([("a", 2.5), ("ghost", 1.0)], "sku_id string, predicted_demand double")
    rows = marts.forecast_mart(star.with_derived(forecasts=forecasts)).collect()
    assert [(r.sku_id, r.predicted_revenue) for r in rows] == [("a", 25.0)]


def test_cluster_display_cleans_text(spark):
    rows = spark.createDataFrame(
        [("a", "1.5", None, "250"), ("b", "x", "7", None)],
        "sku_id string, avg_daily_demand string, total_revenue string, inventory_turns string",
    )
    got = {r.sku_id: (r.avg_daily_demand, r.total_revenue, r.inventory_turns, r.size_value) for r in marts.cluster_display(rows).collect()}
    assert got == {"a": (1.5, 0.0, 250.0, 100.0), "b": (0.0, 7.0, 1.0, 1.0)}


def test_supplier_marts(star):
    row = suppliers.supplier_scorecard(star).first()
    lead, std = 6.0, 2**0.5
    assert row.reliability_score == pytest.approx(0.95 * 30 + 0.5 * 40 + (1 - std / lead) * 30, abs=0.05)
    assert suppliers.monthly_supplier_performance(star).count() == 2
    assert float(suppliers.contract_rates(star).first().fill_rate_pct) == 98.0


def test_segments(make_star):
    products = [product(f"k{i}") for i in range(40)] + [product("idle")]
    sales = [sale(f"k{i}", n, (i % 4) * 50 + 1 + n % 3, Decimal((i % 4) * 1000 + 10)) for i in range(40) for n in range(4)]
    inventory = [snapshot(f"k{i}", n, 10) for i in range(40) for n in range(4)]
    star = make_star(products=products, sales=sales, inventory=inventory)
    idle = segments.sku_features(star).where("sku_id = 'idle'").first()
    assert (idle.avg_daily_demand, idle.demand_cv, idle.inventory_turns, idle.total_revenue) == (0, 0, 0, 0)
    result = segments.segment_skus(star, k=4, restarts=4)
    assert result.silhouette > 0.8
    summary = segments.cluster_summary(result.clusters).collect()
    assert [r.cluster_label for r in summary] == ["A", "B", "C", "D"]
    revenue = [r.avg_revenue for r in summary]
    assert revenue == sorted(revenue, reverse=True) and sum(r.sku_count for r in summary) == 41
    assert {r.cluster_label: r.description[:6] for r in segments.describe_segments(result.clusters).collect()}["A"] == "HIGH V"
    more = segments.segment_skus(star, k=5, restarts=2).clusters
    assert {r.cluster_label for r in more.select("cluster_label").distinct().collect()} == {"A", "B", "C", "D"}
    assert [r.k for r in segments.choose_k(star, max_k=3, restarts=1).collect()] == [2, 3]


def test_revenue_quartiles_are_right_closed(make_star):
    star = make_star(sales=[sale(f"k{i}", 0, 1, Decimal(i)) for i in range(1, 6)])
    got = {r.sku_id: r.cluster_label for r in segments.revenue_quartiles(star).collect()}
    assert got == {"k1": "D", "k2": "D", "k3": "C", "k4": "B", "k5": "A"}
