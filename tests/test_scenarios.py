import random
from decimal import Decimal

import pytest

from conftest import product, sale
from shelfline.operators import scenarios as sc


@pytest.fixture
def random_star(make_star):
    r = random.Random(5)
    products = [
        product(f"k{i}", safety_stock=r.randint(0, 30), reorder_point=r.randint(0, 40), lead_time_days=r.randint(0, 12),
                min_order_qty=r.randint(0, 90), unit_price=Decimal(r.randint(100, 90000)) / 100)
        for i in range(15)
    ]
    sales, demand = [], {}
    for p in products[:-1]:  # the last product has no sales
        units = [r.choice([0, 0, r.randint(1, 30)]) for _ in range(70)]
        units[0] = units[-1] = 1
        demand[p["sku_id"]] = units
        sales += [sale(p["sku_id"], n, u) for n, u in enumerate(units) if u]
    return make_star(products=products, sales=sales), {p["sku_id"]: p for p in products}, demand


def test_demand_change(random_star):
    star, products, demand = random_star
    rows = {r.sku_id: r for r in sc.demand_change(star, 30).collect()}
    assert set(rows) == set(demand)
    for sku, r in rows.items():
        assert r.recommended_safety_stock == int(products[sku]["safety_stock"] * 1.3)
        assert r.recommendation.startswith("Increase")
    assert sc.demand_change(star, -10).first().recommendation == "Consider reducing inventory levels"


def test_demand_stats(make_star):
    star = make_star(sales=[sale("a", 0, 5), sale("b", 0, 2), sale("b", 1, 4)])
    got = {r.sku_id: (r.avg_demand, round(r.std_demand, 6), r.total_demand) for r in sc.demand_stats(star).collect()}
    assert got == {"a": (5.0, 0.0, 5), "b": (3.0, 1.414214, 6)}
