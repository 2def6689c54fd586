"""The ledger as one row per SKU: the levels of a plain loop, stored once, and read without making days."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import __spark_entry__ as entry
import pytest
from conftest import SF, day, order, product, sale, supplier, table
from pyspark.sql import functions as F
from shelfline import schemas
from shelfline.functions import dates
from shelfline.operators import ledger, marts, overstock, safety_stock
from shelfline.plans import facts
from shelfline.sources import sinks
from shelfline.sources.shared import new_folder
from shelfline.star import Star

DAYS = 70


@pytest.fixture(scope="module")
def made(spark):
    """Products, sales and receipts with what is odd: a SKU listed three times with other limits, no limits, no SKU,
    movements without a day, without an amount, before the first and after the last day, several on one day."""
    r = random.Random(11)
    skus = [f"k{i}" for i in range(10)]
    products = [
        product(s, max_stock_level=r.randint(5, 60), reorder_point=r.randint(1, 40), unit_price=Decimal(r.randint(100, 9999)).scaleb(-2))
        for s in [*skus, "k4", "k4"]
    ] + [product(None)]
    products[2]["reorder_point"] = products[3]["max_stock_level"] = products[5]["unit_price"] = None
    sales = [sale(s, r.randrange(DAYS), r.choice([None, 0, r.randint(1, 30)])) for s in skus[1:] for _ in range(15)]
    sales += [sale("k1", 0, 50), sale("k1", DAYS - 1, 1), sale("k5", 0, 9) | {"date": None}, sale("k6", 0, None) | {"date": None}]
    sales += [sale(None, 3, 4), sale("orphan", 3, 4)]
    receipts = [(s, day(r.randrange(-5, DAYS + 5)), r.choice([None, r.randint(5, 40)])) for s in [*skus, None, "orphan"] for _ in range(6)]
    receipts += [("k7", None, 8), ("k8", None, None), ("k9", day(4), 3), ("k9", day(4), 4)]
    return products, sales, receipts


def loop(made):
    """Every day of every listing, day by day."""
    products, sales, receipts = made
    sold, change = defaultdict(int), defaultdict(int)
    for row in sales:
        sold[row["sku_id"], row["date"]] += row["units_sold"] or 0
        change[row["sku_id"], row["date"]] -= row["units_sold"] or 0
    for sku, when, units in receipts:
        change[sku, when] += units or 0
    days, listings, rows = [day(n) for n in range(-10, DAYS)], defaultdict(int), []
    for p in products:
        sku, full, low = p["sku_id"], p["max_stock_level"], p["reorder_point"]
        if sku is None:
            continue
        copies = sum(q["sku_id"] == sku for q in products)
        for number in range(copies):
            start = None if full is None else full * 7 // 10
            stock = None if full is None else max(0, start + change[sku, None])
            for when in days:
                before = stock if when > day(0) else start
                stock = None if full is None else max(0, stock + change[sku, when])
                seen = stock if number else before
                if when >= day(0):
                    triggered = None if seen is None or low is None else seen <= low
                    rows.append((sku, when, stock, sold[sku, when], triggered, p["unit_price"], low))
        listings[sku] += 1
    return sorted(map(str, rows))


def shown(levels):
    names = ("sku_id", "date", "on_hand_qty", "units_sold", "reorder_triggered", "unit_price", "reorder_point")
    return sorted(str(tuple(row)) for row in dates.each_day(levels).select(*names).collect())


def tables(spark, made):
    products, sales, receipts = made
    return (
        table(spark, schemas.PRODUCTS, products), table(spark, schemas.SALES, sales),
        spark.createDataFrame(receipts, "sku_id string, date date, received int"),
    )


def test_series_are_the_loop(spark, made):
    products, sales, receipts = tables(spark, made)
    series = ledger.build_series(products, sales, receipts, (day(0), day(DAYS - 1)), tasks=3)
    assert series.count() == 9 + 3 * 3
    assert shown(ledger.levels_of(series)) == loop(made)
    packed = receipts.groupBy("sku_id", "received").agg(F.collect_list("date").alias("dates"))
    undated = receipts.where("date is null").select("sku_id", "received", F.array("date").alias("dates"))
    again = ledger.build_series(products, sales, packed.unionByName(undated), (day(0), day(DAYS - 1)), tasks=3)
    assert shown(ledger.levels_of(again)) == loop(made)
    none = ledger.build_series(products, sales.limit(0), receipts, tasks=3)
    assert ledger.levels_of(none).count() == 0


def test_levels_stay_in_the_partitions_of_their_skus(spark, made):
    levels = ledger.build_levels(*tables(spark, made), (day(0), day(DAYS - 1)), tasks=3)
    plan = ledger.ledger_rollup(ledger.with_measures(levels))._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("ArrowEvalPython")]
    assert plan.count("ArrowEvalPython") == 1 and above.count("Exchange") == above.count("REPARTITION_BY_NUM") == 1, plan


@pytest.fixture(scope="module")
def star(spark, made):
    products, sales, receipts = tables(spark, made)
    bounds = (day(0), day(DAYS - 1))
    summed = ledger.daily_demand(sales).withColumn("category", F.lit("x"))
    sold = summed.select("date", "sku_id", "units_sold", "revenue", "category")
    series = ledger.build_series(products, sold, receipts, bounds, 3, summed=True)
    levels = ledger.levels_of(series)
    spans = ledger.with_measures(levels)
    suppliers, orders = table(spark, schemas.SUPPLIERS, [supplier("s1")]), table(spark, schemas.ORDERS, [order("o", 3)])
    return Star(products, suppliers, sold, dates.each_day(spans), orders, buckets=3, spans=spans, levels=levels, series=series, cut_at_sales=True)


def test_one_row_per_series_is_stored(spark, star):
    """Not one row per span: the files hold the arrays, and the spans made of them are the same."""
    folder = new_folder(spark, "test")
    stored = sinks.store_by_sku(star, folder)
    assert spark.read.parquet(f"{folder}/fact_inventory").count() == 18 < star.spans.count() / 5
    assert stored.spans.dtypes == star.spans.dtypes
    assert sorted(map(str, stored.spans.collect())) == sorted(map(str, star.spans.collect()))
    assert "Exchange" not in facts.inventory_by_sku(stored.stock)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("report", [overstock.overstock_by_sku, safety_stock.safety_stock_by_sku, safety_stock.inadequate_safety_stock])
def test_stock_with_sales_is_not_made_of_days(spark, star, report):
    stored = sinks.store_by_sku(star, new_folder(spark, "test"))
    plain = star.with_derived(inventory=star.inventory)
    assert plain.series is None and not plain.cut_at_sales
    got, wanted = report(stored), report(plain)
    assert got.dtypes == wanted.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())) and wanted.count()
    assert "sequence(0" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert not stored.with_derived(sales=star.sales).cut_at_sales


def test_sums_are_exact(spark):
    """Costs of ten digits over a month, and values near the ends of their types."""
    rows = [("a", Decimal("99999999.99"), 31), ("a", Decimal("0.01"), 7), ("a", Decimal("-5.55"), 3), ("b", None, 3)]
    df = spark.createDataFrame(rows, "sku_id string, cost decimal(10,2), days int")
    got = df.groupBy("sku_id").agg(facts.sum_over_days(df, "cost").alias("cost"))
    assert got.schema["cost"].dataType.simpleString() == "decimal(20,2)"
    assert dict(got.collect()) == {"a": sum(c * d for _, c, d in rows[:3]), "b": None}


def test_health_values_are_exact(spark, make_star):
    big = 2**31 - 1
    products = [product("a", unit_price=Decimal("99999999.99")), product("b", unit_price=None), product("c", unit_price=Decimal("0.07"))]
    star = make_star(products=products)
    cells = [("a", big), ("a", big), ("b", 4), ("c", 3), ("c", None)]
    stock = table(spark, schemas.INVENTORY, [_row(s, n, q) for n, (s, q) in enumerate(cells)])
    got = marts.inventory_health_rollup(star.with_derived(inventory=stock))
    assert got.schema["inventory_value"].dataType.simpleString() == "decimal(31,2)" and got.schema["month"].dataType.simpleString() == "string"
    found = sorted((r.sku_id, r.month, str(r.inventory_value)) for r in got.collect())
    twice = str(2 * big * Decimal("99999999.99"))
    assert found == [("a", "2024-01", twice), ("b", "2024-01", "None"), ("c", "2024-01", "0.21"), ("c", "2024-01", "None")]


def _row(sku, n, quantity):
    from conftest import snapshot

    return snapshot(sku, n, quantity) | {"carrying_cost_daily": Decimal(0)}


def test_dealt_features_are_stored_once(spark):
    """Ranking the clusters and labelling the SKUs read the stored features, not the facts."""
    files = entry._assigned_star(spark, SF).clusters.inputFiles()
    assert files and all("/dealt-" in name for name in files)


def test_month_starts_are_the_calendar():
    from shelfline.functions.balances import EPOCH, month_starts

    got = [EPOCH + dt.timedelta(days=n) for n in month_starts(dt.date(1999, 11, 5), dt.date(2000, 2, 1))]
    assert got == [dt.date(1999, 11, 5), dt.date(1999, 12, 1), dt.date(2000, 1, 1), dt.date(2000, 2, 1)]
    assert month_starts(None, None) == []
