from decimal import Decimal

from conftest import day, order, product, sale, snapshot
from pyspark.sql import functions as F

from shelfline.operators import alerts as al


def stocked(sku, quantities, **values):
    return [snapshot(sku, n, q, **values) for n, q in enumerate(quantities)]


def test_each_detector(make_star):
    n = 40
    healthy = [20] * n
    star = make_star(
        products=[product(s) for s in ("crit", "high", "fine", "low", "full", "late")]
        + [product("named", product_name="x" * 80)],
        sales=[sale("low", i, 10) for i in range(n - 1)] + [sale("low", n - 1, 60), sale("fine", n - 1, 3)],
        inventory=stocked("crit", [0] * 3 + [20] * 20 + [0] * 7 + [20] * 10)
        + stocked("high", [20] * 30 + [0, 20, 0, 20, 0] + [20] * 5)
        + stocked("fine", [0] * 8 + [20] * 32)  # empty only before the window
        + stocked("low", healthy[:-1] + [4])
        + stocked("full", healthy[:-1] + [61])
        + stocked("ghost", [20] * 39 + [4]) + stocked("named", [20] * 39 + [4]),
        orders=[order("d2", 39, 2), order("d3", 39, 3), order("d7", 39, 7, sku="ghost"), order("old", 5, 9)],
    )
    found = al.detect_alerts(star, as_of=F.lit("2024-02-10").cast("timestamp"))
    rows = found.collect()
    by = {}
    for r in rows:
        by.setdefault(r.alert_type, {})[r.order_id or r.sku_id] = r
    assert {k: r.priority_label for k, r in by["STOCKOUT"].items()} == {"crit": "CRITICAL", "high": "HIGH"}
    assert by["STOCKOUT"]["crit"].message == "Critical stockout: 7 days without inventory"
    assert set(by["LOW_STOCK"]) == {"low", "ghost", "named"}
    assert by["LOW_STOCK"]["ghost"].product_name == "Unknown" and len(by["LOW_STOCK"]["named"].product_name) == 50
    assert by["LOW_STOCK"]["low"].message == "Inventory critically low: 4 units (safety stock: 10)"
    assert {k: r.excess_units for k, r in by["OVERSTOCK"].items()} == {"full": 21}
    assert set(by["SLG_BREACH"]) == {"crit"}  # 28 of 31 days is still above 90%
    assert by["SLG_BREACH"]["crit"].message == "Service level below target: 77.4% vs 95.0% target"
    assert by["SLG_BREACH"]["crit"].gap_pct == 17.6
    assert {k: r.current_demand for k, r in by["DEMAND_SPIKE"].items()} == {"low": 60}
    assert {k: r.priority_label for k, r in by["SUPPLIER_DELAY"].items()} == {"d3": "MEDIUM", "d7": "HIGH"}
    assert {str(r.timestamp)[:10] for r in rows} == {"2024-02-10"}

    summary = al.alert_summary(found).collect()
    total = [r for r in summary if r.priority_label is None and r.alert_type is None][0]
    assert (total.alerts, total.critical) == (len(rows), 1)
    assert sum(r.alerts for r in summary if r.alert_type) == len(rows) == sum(r.alerts for r in summary if r.priority_label)
    urgent = al.urgent_alerts(found, 3).collect()
    assert [r.alert_type for r in urgent] == ["STOCKOUT", "LOW_STOCK", "LOW_STOCK"]


def test_total_days_or_longest_run(make_star):
    star = make_star(products=[product("a")], inventory=stocked("a", [0, 0, 5, 0, 0, 5, 0, 5]))
    assert al.stockout_alerts(star.inventory, star.products).first().stockout_days == 5
    assert al.stockout_alerts(star.inventory, star.products, consecutive=True).count() == 0


def test_window_is_inclusive(make_star):
    rows = stocked("a", [0] * 3 + [20] * 31)  # days 0-33, window from day 3
    star = make_star(products=[product("a")], inventory=rows)
    assert al.detect_alerts(star).where("alert_type = 'STOCKOUT'").count() == 0
    wider = al.detect_alerts(star, al.Thresholds(lookback_days=33))
    assert wider.where("alert_type = 'STOCKOUT'").first().stockout_days == 3


def test_one_sale_is_no_spike(make_star):
    star = make_star(products=[product("a")], sales=[sale("a", 0, 900)])
    assert al.demand_spike_alerts(star.sales, star.products).count() == 0


def test_slg_gap_uses_five_points(make_star):
    # 18 of 20 days in stock is 90%: not below 95% - 5%.
    star = make_star(products=[product("a", slg_target=Decimal("0.9500"))], inventory=stocked("a", [0, 0] + [20] * 18))
    assert al.service_level_alerts(star.inventory, star.products).count() == 0
    assert day(0).year == 2024
