from __future__ import annotations

import datetime as dt
import os
import random
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline import schemas  # noqa: E402
from shelfline.session import build_session  # noqa: E402
from shelfline.star import Star  # noqa: E402

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def day(n: int) -> dt.date:
    return DAY + dt.timedelta(days=n)


def product(sku, **values):
    row = dict(
        sku_id=sku, product_name=f"name {sku}", brand="b", category="c1", sub_category="s",
        unit_price=Decimal("10.00"), lead_time_days=3, safety_stock=10, min_order_qty=5, max_stock_level=40,
        reorder_point=15, supplier_id="s1", slg_target=Decimal("0.9500"), order_policy="EOQ",
    )
    return row | values


def supplier(key, **values):
    row = dict(
        supplier_id=key, supplier_name=f"supplier {key}", avg_lead_time=5, lead_time_variance=1,
        fill_rate=Decimal("0.9800"), on_time_delivery_rate=Decimal("0.9500"), min_order_value=Decimal("100.00"),
    )
    return row | values


def sale(sku, n, units, revenue=None):
    return dict(date=day(n), sku_id=sku, units_sold=units, revenue=Decimal(revenue if revenue is not None else (units or 0)), category="x")


def snapshot(sku, n, on_hand, **values):
    qty = on_hand
    row = dict(
        date=day(n), sku_id=sku, on_hand_qty=qty, units_sold=0, reorder_triggered=False,
        stockout_flag=qty == 0, overstock_flag=qty is not None and qty > 40, days_of_supply=Decimal("1.0"),
        safety_stock=10, reorder_point=15, instock_flag=qty is not None and qty > 0,
        carrying_cost_daily=Decimal(qty or 0) * Decimal("0.01"),
    )
    return row | values


def order(key, n, late=0, sku="a", supplier_id="s1", **values):
    row = dict(
        order_id=key, order_date=day(n), sku_id=sku, supplier_id=supplier_id, order_qty=5,
        expected_delivery_date=day(n + 5), actual_delivery_date=day(n + 5 + late), lead_time_actual=5 + late,
        fill_rate_actual=Decimal("0.9500"),
    )
    return row | values


def table(spark, ddl, rows):
    from pyspark.sql import types as T

    names = T.StructType.fromDDL(ddl).fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)


@pytest.fixture
def make_star(spark):
    def build(products=(), suppliers=(), sales=(), inventory=(), orders=(), **derived):
        return Star(
            table(spark, schemas.PRODUCTS, products), table(spark, schemas.SUPPLIERS, suppliers),
            table(spark, schemas.SALES, sales), table(spark, schemas.INVENTORY, inventory),
            table(spark, schemas.ORDERS, orders), **derived,
        )

    return build


def untidy_rows(seed: int) -> dict[str, list[dict]]:
    """Random tables with what the benchmark data lacks: SKUs without sales or stock, suppliers
    without orders, missing quantities, facts without a product, several rows per SKU and day."""
    r = random.Random(seed)
    skus = [f"k{i}" for i in range(8)]
    listed = skus[:6]
    products = [
        product(
            s, category=r.choice(["c1", "c2", "c3"]), unit_price=Decimal(r.randint(100, 9999)) / 100,
            lead_time_days=r.randint(1, 9), safety_stock=r.randint(1, 30), min_order_qty=r.randint(1, 60),
            max_stock_level=r.randint(1, 80), reorder_point=r.randint(1, 60), supplier_id=f"s{r.randint(1, 3)}",
            slg_target=Decimal(r.choice(["0.5000", "0.9500", "0.9900"])), order_policy=r.choice(["EOQ", "Min-Max"]),
        )
        for s in listed
    ]
    sales, inventory = [], []
    for s in skus[1:]:
        for n in range(60):
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                units = r.choice([None, 0, r.randint(1, 30)])
                sales.append(sale(s, n, units, Decimal(r.randint(0, 2000000)) / 100))
    for s in [skus[0], *skus[2:]]:
        for n in range(60):
            for _ in range(r.choice([0, 1, 1, 1, 2])):
                inventory.append(snapshot(s, n, r.choice([None, 0, 0, r.randint(1, 90)])))
    orders = [
        order(f"o{i:04d}", r.randint(0, 59), r.randint(-4, 9), r.choice(skus), f"s{r.choice([1, 2, 9])}",
              fill_rate_actual=Decimal(r.randint(80, 100)) / 100)
        for i in range(80)
    ]
    return dict(products=products, suppliers=[supplier(f"s{i}") for i in range(1, 5)], sales=sales,
                inventory=inventory, orders=orders)
