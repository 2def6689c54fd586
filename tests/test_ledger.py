import random
from decimal import Decimal

from conftest import day, product, sale, supplier, table
from shelfline import schemas
from shelfline.operators import ledger


def replay(start, price, reorder, maximum, sold, received):
    """The ledger of one SKU as a plain loop."""
    rows, stock = [], start
    for units, arriving in zip(sold, received):
        trigger = stock <= reorder
        stock = max(0, stock + arriving - units)
        rows.append((stock, units, trigger, stock == 0, stock > maximum))
    return rows


def test_ledger_equals_the_day_by_day_loop(spark):
    r = random.Random(7)
    days, skus = 50, [f"k{i}" for i in range(12)]
    products = [product(s, max_stock_level=r.randint(5, 60), reorder_point=r.randint(1, 30)) for s in skus]
    sales, receipts, expected = [], [], {}
    for p in products:
        sold, received = [0] * days, [0] * days
        for n in range(days):
            for _ in range(r.choice([0, 1, 2])):  # several sales on one day
                units = r.randint(0, 25)
                sold[n] += units
                sales.append(sale(p["sku_id"], n, units))
            if r.random() < 0.2:
                received[n] += 20
                receipts.append((p["sku_id"], day(n), 20))
        expected[p["sku_id"]] = replay(p["max_stock_level"] * 7 // 10, 10, p["reorder_point"], p["max_stock_level"], sold, received)
    sales += [sale("k0", 0, 0), sale("k0", days - 1, 0), sale("orphan", 3, 9)]
    got = ledger.build_ledger(
        table(spark, schemas.PRODUCTS, products), table(spark, schemas.SALES, sales),
        spark.createDataFrame(receipts, "sku_id string, date date, received int"),
    ).orderBy("sku_id", "date").collect()
    assert len(got) == days * len(skus)
    for sku in skus:
        rows = [g for g in got if g.sku_id == sku]
        assert [(g.on_hand_qty, g.units_sold, g.reorder_triggered, g.stockout_flag, g.overstock_flag) for g in rows] == expected[sku]
    assert all(g.instock_flag != g.stockout_flag and g.on_hand_qty >= 0 for g in got)
    for g in got:
        assert g.days_of_supply == (Decimal(g.on_hand_qty) / (g.units_sold or 5)).quantize(Decimal("0.1"))
        assert g.carrying_cost_daily == (Decimal(g.on_hand_qty) * 10 * Decimal("0.0005")).quantize(Decimal("0.01"))


def test_demand_is_zero_on_days_without_sales(spark):
    products = table(spark, schemas.PRODUCTS, [product("a"), product("b")])
    sales = table(spark, schemas.SALES, [sale("a", 0, 3), sale("a", 0, 4), sale("a", 2, 1)])
    got = ledger.demand_on_calendar(products, sales).orderBy("sku_id", "date").collect()
    assert [(g.sku_id, g.units_sold) for g in got] == [("a", 7), ("a", 0), ("a", 1), ("b", 0), ("b", 0), ("b", 0)]


def test_orders_from_triggers(spark, make_star):
    star = make_star(
        products=[product("a"), product("b", supplier_id="unknown")],
        suppliers=[supplier("s1", avg_lead_time=4)],
        inventory=[
            dict(row, reorder_triggered=t)
            for row, t in [(_snapshot("a", 0), True), (_snapshot("a", 1), False), (_snapshot("b", 1), True)]
        ],
    )
    got = ledger.triggered_orders(star.inventory, star.products, star.suppliers).collect()
    assert [(g.order_id, g.order_qty, g.expected_delivery_date) for g in got] == [("ORD-a-20240101", 5, day(4))]


def _snapshot(sku, n):
    from conftest import snapshot

    return snapshot(sku, n, 5)
