"""The driver contract, and the shape of the plans behind it."""

from __future__ import annotations

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
import check
from conftest import SF
from shelfline.operators import ledger
from shelfline.plans import catalogue

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
# Fitted models and what is built on their cluster numbers.
WITHOUT_SQL = {"choose_k", "sku_clusters"}
TEXT = {name for name in QUERIES if name == "pipeline" or name.startswith("op")}  # tested in tests/llm


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in check.TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(SQL) - TEXT == WITHOUT_SQL and set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 200


@pytest.mark.parametrize("name", sorted(set(SQL) - TEXT))
def test_query_equals_its_twin(spark, duck, name):
    verdict = check.compare(QUERIES[name](spark, SF), SQL[name], duck)
    assert verdict.startswith("ok"), verdict


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_joins_and_no_forced_broadcast(spark):
    for name in sorted(set(QUERIES) - TEXT - {"choose_k"}):  # a few numbers made by the driver
        df = QUERIES[name](spark, SF)
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString(), name


def test_scans_read_only_what_is_needed(spark):
    star = entry_points._star(spark, SF)
    text = plan(catalogue.INVENTORY_REPORTS["instock_by_category"](star))
    assert "on_hand_qty" not in text and "carrying_cost_daily" not in text
    late = plan(catalogue.INVENTORY_REPORTS["supplier_by_month"](star))
    assert "l_extendedprice" not in late and "l_discount" not in late


@pytest.fixture
def large_tables(spark):
    """Joins as they are when no side is small enough to be sent to every task."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def above_scan(text: str) -> list[str]:
    """The lines of a plan from the scan of the inventory up to the top, by indentation."""
    depth_of = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and re.search("on_hand_qty|instock_flag|stockout_flag", line))
    path, depth = [], depth_of(lines[at])
    for line in reversed(lines[:at]):
        if depth_of(line) < depth:
            path.append(line.strip(" :+-"))
            depth = depth_of(line)
    return path


BY_SKU = ["overstock_by_sku", "excess_weeks_of_supply", "top_exceptions", "safety_stock_by_sku", "inadequate_safety_stock", "excess_safety_stock"]


@pytest.mark.parametrize("name", [*BY_SKU, "turns_by_month", "daily_health", "inventory_health_rollup", "daily_instock_by_category", "instock_by_sku"])
def test_buckets_leave_the_inventory_where_it_is(spark, large_tables, name):
    """Stock meets products and sales, and is added up, where it is read: no row of the inventory
    is shuffled before partial sums, however large the other sides are."""
    star = entry_points._star(spark, SF)
    text = plan((catalogue.INVENTORY_REPORTS | catalogue.MART_REPORTS)[name](star))
    path = above_scan(text)
    kinds = [line.split("(")[0].split(" ")[0] for line in path]
    assert "HashAggregate" in kinds, text
    assert "Exchange" not in kinds[: kinds.index("HashAggregate")], text
    if name in BY_SKU:
        assert not any(line.startswith("Exchange hashpartitioning") for line in path), text


def test_runs_read_the_inventory_once(spark, large_tables):
    text = plan(catalogue.INVENTORY_REPORTS["longest_stockouts"](entry_points._star(spark, SF)))
    assert text.count("stockout_flag") and sum("Scan parquet" in line and "stockout_flag" in line for line in text.split("\n")) == 1
    assert text.count("Exchange") <= 4, text


def test_stored_star_gives_the_same_reports(spark):
    """Buckets, the sales looked up in them and the plain join agree."""
    star = entry_points._star(spark, SF)
    plain = star.with_derived(sales_of_sku=None)
    for name in ("overstock_by_sku", "turns_by_month"):
        report = catalogue.INVENTORY_REPORTS[name]
        assert sorted(map(str, report(star).collect())) == sorted(map(str, report(plain).collect()))


def test_tasks_grow_with_the_calendar():
    bounds = (dt.date(2020, 1, 1), dt.date(2024, 12, 31))
    assert ledger.calendar_tasks(10_000, bounds) * 2 in range(ledger.calendar_tasks(20_000, bounds), ledger.calendar_tasks(20_000, bounds) + 2)
    assert ledger.calendar_tasks(10, (None, None)) == 1


def test_calendar_is_not_shuffled(spark):
    text = plan(entry_points._lazy_star(spark, SF).inventory)
    above_union = text.split("Union")[0]
    assert "hashpartitioning" not in above_union
