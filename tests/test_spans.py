"""Days in a row that are alike are one row of the stock: the same reports and the same tables."""

import random
from decimal import Decimal

import pytest
from conftest import day, order, product, sale, supplier, table
from pyspark.sql import functions as F
from shelfline import schemas
from shelfline.functions import dates
from shelfline.operators import ledger
from shelfline.plans import catalogue
from shelfline.sources import sinks
from shelfline.sources.shared import new_folder
from shelfline.star import Star

DAYS = 75


@pytest.fixture(scope="module")
def stars(spark):
    """A star with spans, and the same star with its days alone. One SKU is listed twice, one has
    no reorder point, one no price, one no sales; sales come without a day and without units."""
    r = random.Random(3)
    names = [f"k{i}" for i in range(9)]
    products = [
        product(s, category=r.choice("xyz"), max_stock_level=r.randint(5, 60), reorder_point=r.randint(1, 40), supplier_id=f"s{i % 3}",
                unit_price=Decimal(r.randint(100, 9999)) / 100)
        for i, s in enumerate([*names, "k4"])
    ]
    products[2]["reorder_point"] = products[3]["unit_price"] = None
    sales = [sale(s, r.randrange(DAYS), r.choice([None, 0, r.randint(1, 30)])) for s in names[1:] for _ in range(12)]
    sales += [sale("k5", 0, 3) | {"date": None}, sale("orphan", 0, 2), sale("k1", DAYS - 1, 1), sale("k1", 0, 50)]
    receipts = [(s, day(r.randrange(DAYS)), r.randint(5, 40)) for s in names for _ in range(5)]
    listed, sold = table(spark, schemas.PRODUCTS, products), table(spark, schemas.SALES, sales)
    spans = ledger.build_spans(listed, sold, spark.createDataFrame(receipts, "sku_id string, date date, received int"))
    suppliers = [supplier("s0"), supplier("s1", avg_lead_time=40), supplier("s2", avg_lead_time=None)]
    orders = table(spark, schemas.ORDERS, [order("o", 3)])
    inventory = dates.each_day(spans).localCheckpoint()
    plain = Star(listed, table(spark, schemas.SUPPLIERS, suppliers), sold, inventory, orders)
    return plain.with_derived(spans=spans.localCheckpoint(), buckets=1), plain


def text(df):
    return sorted(map(str, df.collect()))


def test_spans_are_few_and_cover_every_day_once(stars):
    star, plain = stars
    assert star.spans.count() * 3 < plain.inventory.count() == DAYS * (8 + 2 * 2)
    assert star.spans.where(F.trunc("date", "MM") != F.trunc(dates.end_of(star.spans), "MM")).count() == 0
    assert plain.inventory.where("sku_id <> 'k4'").groupBy("sku_id", "date").count().where("count > 1").count() == 0


REPORTS = catalogue.LEDGER_REPORTS | {
    name: catalogue.STOCK_REPORTS[name]
    for name in (
        "instock_by_sku", "instock_by_month", "stockout_by_month", "overstock_by_category", "longest_stockouts", "mean_stockout_days",
        "consecutive_stockout_alerts", "alert_counts", "alerts", "kpi_summary", "inventory_health_rollup", "monthly_instock_by_category",
        "parameters_to_adjust", "exception_mart_without_alerts", "stockout_heatmap", "turns_by_sku",
    )
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_count_a_span_for_its_days(stars, name):
    got, wanted = (REPORTS[name](star) for star in stars)
    assert got.dtypes == wanted.dtypes
    assert text(got) == text(wanted) and wanted.count()


def test_reports_are_not_made_of_days(stars):
    """The ledger is stored and added up as spans; only what shows days makes them."""
    star = sinks.store_by_sku(stars[0], new_folder(stars[0].products.sparkSession, "test"))
    assert dates.DAYS in star.spans.columns and text(star.inventory) == text(stars[1].inventory)
    for name in ("instock_by_sku", "monthly_instock_by_category", "mean_stockout_days"):
        assert "Generate" not in REPORTS[name](star)._jdf.queryExecution().executedPlan().toString(), name


def test_ledger_is_written_by_the_tasks_that_make_it(spark, stars):
    """Neither shuffled nor sorted by month, and the setting that spares the sort is put back."""
    star, plain = stars
    before = spark.conf.get(sinks.OPEN_FILES)
    folder = new_folder(spark, "test")
    counts = {r.table_name: r.rows for r in sinks.write_star(star, folder).collect()}
    assert counts["fact_inventory"] == plain.inventory.count() and spark.conf.get(sinks.OPEN_FILES) == before
    back = spark.read.parquet(f"{folder}/fact_inventory")
    assert text(back.drop(dates.PARTITION)) == text(plain.inventory)
    assert back.where(F.col(dates.PARTITION) != F.date_format("date", "yyyy-MM")).count() == 0
    assert back.select(F.input_file_name()).distinct().count() == 3  # one task, three months
    with_new_rows = star.with_derived(inventory=plain.inventory.limit(1))
    assert with_new_rows.stock.count() == 1 and with_new_rows.buckets is None


@pytest.mark.parametrize("name", ["daily_health", "daily_instock_by_category"])
def test_daily_reports_are_made_of_spans(stars, name):
    """The same rows and types as from the days, and no day is made of a span before it is added up."""
    got, wanted = (catalogue.STOCK_REPORTS[name](star) for star in stars)
    assert got.dtypes == wanted.dtypes
    assert text(got) == text(wanted) and wanted.count()
    explodes = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate explode" in line]
    assert len(explodes) == 1, explodes


def test_sales_of_a_sku_are_stored_when_asked_for(stars, monkeypatch):
    """Reports on stock alone neither add up nor write the sales per SKU."""
    written = []
    write = sinks.write_buckets
    monkeypatch.setattr(sinks, "write_buckets", lambda df, path, *a, **k: written.append(path.split("/")[-1]) or write(df, path, *a, **k))
    star = sinks.store_by_sku(stars[0], new_folder(stars[0].products.sparkSession, "test"))
    catalogue.STOCK_REPORTS["kpi_summary"](star).collect()
    assert "sales_of_sku" not in written
    for _ in range(2):
        catalogue.STOCK_REPORTS["overstock_by_sku"](star).collect()
    assert written.count("sales_of_sku") == 1


def test_calendar_of_receipts_is_made_after_it_is_dealt_out(spark):
    """Receipts as one row per SKU with its days give the ledger of the same receipts by day."""
    listed = table(spark, schemas.PRODUCTS, [product("a"), product("b"), product("c")])
    sold = table(spark, schemas.SALES, [sale("a", 0, 30), sale("a", 9, 4), sale("b", 40, 60)])
    packed = spark.createDataFrame(
        [("a", 7, [day(3), day(31)]), ("b", 9, [day(0)]), ("b", 2, [day(40)]), ("c", 1, [])], "sku_id string, received int, dates array<date>"
    )
    by_day = packed.select("sku_id", F.explode("dates").alias("date"), "received")
    assert text(ledger.build_spans(listed, sold, packed)) == text(ledger.build_spans(listed, sold, by_day))
    bounds = ledger.sales_bounds(sold)
    assert text(ledger.demand_on_calendar(listed, sold, bounds)) == text(ledger.demand_on_calendar(listed, sold))


def test_calendar_tasks_stay_in_memory():
    """At 60 times sf0.1 a stored bucket, or a task of the demand by day, holds at most eight million SKU-days."""
    bounds = (day(0), day(2498))
    tasks = ledger.calendar_tasks(1_200_000, bounds, ledger.IN_MEMORY)
    assert 1_200_000 * 2499 / tasks <= 8_000_000


def test_measures_are_made_of_the_stored_levels(stars):
    """Days of supply and cost are not stored, and are the same as in the ledger by day."""
    plain = stars[1]
    receipts = plain.products.sparkSession.createDataFrame([("k0", 9, [day(3)])], "sku_id string, received int, dates array<date>")
    levels = ledger.build_levels(plain.products, plain.sales, receipts, tasks=3)
    spans = ledger.with_measures(levels)
    star = plain.with_derived(inventory=dates.each_day(spans), spans=spans, levels=levels, buckets=3)
    stored = sinks.store_by_sku(star, new_folder(levels.sparkSession, "test"))
    assert stored.spans.dtypes == spans.dtypes and text(stored.spans) == text(spans)
    plan = stored.spans._jdf.queryExecution().optimizedPlan().toString()
    names = " ".join(line for line in plan.split("\n") if "Relation" in line)
    assert "on_hand_qty" in names and "carrying_cost_daily" not in names and "days_of_supply" not in names
    assert text(stored.inventory) == text(star.inventory)
    assert plain.with_derived(inventory=plain.inventory).levels is None
