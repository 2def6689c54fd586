import os
import subprocess
import sys

import pytest
from conftest import day, order, product, sale, snapshot, supplier

from shelfline.operators.quality import validate
from pyspark.sql import functions as F
from shelfline.functions import dates
from shelfline.sources import sinks, tables
from shelfline.sources.catalogue import catalogue_products, clean_catalogue
from shelfline.sources.shared import new_folder, shared_folder

RULES = {
    "products": (2, ["sku_id"]), "suppliers": (1, ["supplier_id"]), "sales": (1, ["date", "sku_id"]),
    "inventory": (1, ["on_hand_qty"]), "orders": (1, ["order_id"]),
}


def statuses(result):
    return {(r.check, r.table_name): (r.status, r.observed) for r in result.collect()}


def as_tables(star):
    return {n: getattr(star, n) for n in RULES}


def test_clean_tables_pass(make_star):
    star = make_star([product("a"), product("b")], [supplier("s1")], [sale("a", 0, 1), sale("a", 400, 1)],
                     [snapshot("a", 0, 1)], [order("o", 0)])
    got = statuses(validate(as_tables(star), RULES))
    assert got["overall", "all"] == ("PASS", "0")
    assert got["sales_date_range", "sales"] == ("INFO", "2024-01-01 to 2025-02-04")
    assert {s for s, _ in got.values()} == {"PASS", "INFO"}


def test_every_fault_is_found(make_star):
    star = make_star(
        [product("a"), product("a"), product(None), product(None, supplier_id=None), product("b", supplier_id="s9")],
        [supplier("s1")],
        [sale("a", 0, 1), sale("zz", 0, 1), sale(None, 0, 1)],
        [snapshot("a", 0, -1), snapshot("a", 1, 5, stockout_flag=True)],
        [],
    )
    got = statuses(validate(as_tables(star), RULES))
    assert got["null_skus", "products"] == ("FAIL", "2")
    assert got["duplicate_skus", "products"] == ("FAIL", "2")  # one copy of a, one of the missing id
    assert got["unknown_suppliers", "products"] == ("FAIL", "2")
    assert got["unknown_skus", "sales"][0] == "FAIL"
    assert got["negative_on_hand", "inventory"] == ("FAIL", "1")
    assert got["stockout_flag_consistent", "inventory"] == ("WARN", "1")
    assert got["sales_years", "sales"][0] == "WARN" and got["row_count", "orders"] == ("WARN", "0")
    assert got["overall", "all"][0] == "FAIL"


def test_warnings_do_not_fail_but_missing_parts_do(make_star):
    star = make_star([product("a")], [supplier("s1")], [sale("a", 0, 1)], [snapshot("a", 0, 1)], [order("o", 0)])
    assert statuses(validate(as_tables(star), RULES))["overall", "all"] == ("PASS", "0")
    got = statuses(validate(as_tables(star) | {"orders": None, "sales": star.sales.drop("date")}, RULES))
    assert got["table_present", "orders"][0] == "FAIL" and got["required_columns", "sales"] == ("FAIL", "date")
    assert got["overall", "all"] == ("FAIL", "2")


def test_raw_catalogue(spark):
    rows = [
        (1, "s1", "x" * 300, "B", "Audio", "sub", "12.5"), (2, "s1", "later copy", None, None, None, "1"),
        (3, "s2", None, None, "Garden", None, "n/a"), (4, None, "no sku", None, None, None, "2"),
        (0, "s3", "t", "B", None, "sub", None),
    ]
    raw = spark.createDataFrame(
        rows, "`n` int, `SKU` string, `Product Title` string, `Brand` string, `Primary Category` string, "
        "`Sub Category 1` string, `Price` string")
    got = {r.sku_id: r for r in catalogue_products(clean_catalogue(raw, "n")).collect()}
    assert set(got) == {"s1", "s2", "s3"}
    assert (len(got["s1"].product_name), got["s1"].category, got["s1"].unit_price) == (200, "Technology", 12.5)
    assert list(got["s2"]) == ["s2", "Unknown Product", "Generic", "Office Supplies", "General", 25.0]
    assert got["s3"].category == "Office Supplies"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_star_round_trip(spark, make_star, fmt):
    star = make_star([product("a")], [supplier("s1")], [sale("a", 0, 1), sale("a", 40, 2)],
                     [snapshot("a", 0, 1), snapshot("a", 40, 0)], [order("o", 0)])
    folder = new_folder(spark, "test")
    for _ in range(2):  # writing again replaces, it does not append
        counts = {r.table_name: r.rows for r in sinks.write_star(star, folder, fmt).collect()}
    assert counts == {"dim_suppliers": 1, "dim_products": 1, "fact_sales": 2, "fact_inventory": 2, "fact_replenishment_orders": 1}
    back = tables.read_star(spark, folder, fmt)
    assert back.alerts is None and back.clusters is None and back.forecasts is None
    for name in RULES:
        assert sorted(map(str, getattr(back, name).drop(dates.PARTITION).collect())) == sorted(map(str, getattr(star, name).collect())), name


def test_a_month_loaded_again_replaces_itself_alone(spark, make_star):
    import pathlib

    star = make_star([product("a")], [supplier("s1")], [sale("a", n, 1) for n in (0, 40, 80)], [], [order("o", 40)])
    folder = new_folder(spark, "test")
    sinks.load_facts(star, folder)
    files = lambda: {p: p.stat().st_mtime_ns for p in pathlib.Path(f"{folder}/fact_sales").rglob("*.parquet")}
    before = files()
    again = make_star([product("a")], [supplier("s1")], [sale("a", 40, 7), sale("a", 41, 8)], [], [order("o", 40)])
    sinks.load_facts(again, folder, "2024-02")
    after = files()
    kept = {p for p in before if "2024-02" not in str(p)}
    assert len(kept) == 2 and all(after.get(p) == before[p] for p in kept) and set(after) - set(before)
    back = tables.read_star(spark, folder)
    assert sorted(r.units_sold for r in back.sales.collect()) == [1, 1, 7, 8] and back.orders.count() == 1
    sinks.load_facts(again, folder, "2024-02")
    assert spark.read.parquet(f"{folder}/fact_sales").count() == 4


def test_csv_columns_by_name(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("category,sku_id,unit_price,other\nOffice,a,24.99,zzz\n")
    row = tables.read_table(spark, str(path), "sku_id string, brand string, category string, unit_price decimal(10,2)", "csv").first()
    assert (row.sku_id, row.brand, row.category, str(row.unit_price)) == ("a", None, "Office", "24.99")
    path.write_text("category,sku_id,unit_price\nOffice,a,dear\n")
    with pytest.raises(Exception):
        tables.read_table(spark, str(path), "sku_id string, unit_price decimal(10,2)", "csv").collect()


def test_month_pruning(spark, make_star):
    """Date filters reach the partitions: of three months the last one is read for the last day,
    and two for a look-back of thirty days."""
    star = make_star(inventory=[snapshot("a", n, 1) for n in (0, 40, 80)])
    stored = sinks.store_by_sku(star, new_folder(spark, "test"))
    assert stored.inventory.columns == [*star.inventory.columns, dates.PARTITION] and stored.inventory.count() == 3
    today = dates.last_day(stored.inventory)
    for rows, months in ((dates.on_day(stored.inventory, today), 1), (dates.since(stored.inventory, F.date_sub(today, 45)), 2)):
        assert rows.count() == months
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert all("PartitionFilters: []" not in line for line in plan.split("\n") if "on_hand_qty" in line and "PartitionFilters" in line), plan
    literal = dates.since(stored.inventory, F.lit(day(45)))
    literal.collect()
    assert len(literal.inputFiles()) >= 1 and literal.select(F.input_file_name().alias("f")).distinct().count() == 1


ALONE = """
import sys
from shelfline.session import build_session
from shelfline.sources.shared import new_folder
spark = build_session("alone", "local[1]", spark__ui__enabled="false", **dict(a.split("=") for a in sys.argv[1:]))
print("FOLDER", new_folder(spark, "x"))
"""


def test_shared_folder_must_be_named(tmp_path):
    """In a fresh process without any configuration: a clear error, and none with a folder."""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(__file__))}
    run = lambda *args: subprocess.run([sys.executable, "-c", ALONE, *args], env=env, capture_output=True, text=True, timeout=120)
    without = run()
    assert without.returncode and "ValueError: set spark.checkpoint.dir" in without.stderr
    assert f"FOLDER {tmp_path}/x-" in run(f"spark__checkpoint__dir={tmp_path}").stdout


def test_shared_folder_is_the_named_one(spark):
    assert new_folder(spark, "x").startswith(shared_folder(spark))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_of_derived_tables_and_marts(spark, make_star, fmt):
    from shelfline.plans.export import derive_tables, export, mart_tables

    products = [product(f"k{i}") for i in range(6)]
    star = make_star(
        products, [supplier("s1")], [sale(p["sku_id"], n, i * 9 + n % 4) for i, p in enumerate(products) for n in range(64)],
        [snapshot(p["sku_id"], n, 0 if i == 0 else 5) for i, p in enumerate(products) for n in range(64)],
        [order("o", 60, 4, sku="k1")],
    )
    folder = new_folder(spark, "test")
    derived = derive_tables(star)
    counts = {r.table_name: r.rows for r in export(derived, folder, fmt).collect()}
    assert counts["sku_clusters"] == 6 and counts["forecasts"] == 6 * 30 and counts["alerts"] > 0
    sinks.write_star(star, folder, fmt)
    full = tables.read_star(spark, folder, fmt)
    assert full.forecasts.count() == 180
    marts_written = {r.table_name: r.rows for r in export(mart_tables(full), folder + "/marts", fmt).collect()}
    assert marts_written["exception_dashboard"] == counts["alerts"] and marts_written["forecast_data"] == 180
    assert marts_written["kpi_summary"] == 7 and "sku_clusters" in marts_written
    assert "forecast_data" not in mart_tables(star)
