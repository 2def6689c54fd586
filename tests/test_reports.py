"""The SQL reports on untidy random tables, against literal joins in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
import check
from conftest import DAY, day, order, product, sale, snapshot, supplier, untidy_rows
from oracle import base, reports
from shelfline import labels
from shelfline.operators import overstock, safety_stock, stockouts, suppliers, turns
from shelfline.plans import catalogue


@pytest.fixture(scope="module")
def duck():
    return duckdb.connect()


def register(con, rows):
    tables = dict(rows)
    tables["inventory"] = [dict(r, carrying_cost=r["carrying_cost_daily"]) for r in rows["inventory"]]
    tables["suppliers"] = [
        dict(r, fill_pct=int(r["fill_rate"] * 100), on_time_pct=int(r["on_time_delivery_rate"] * 100)) for r in rows["suppliers"]
    ]
    tables["orders_placed"] = [
        dict(r, fill_pct=float(r["fill_rate_actual"] * 100), days_late=(r["actual_delivery_date"] - r["expected_delivery_date"]).days)
        for r in rows["orders"]
    ]
    casts = dict(
        carrying_cost="DECIMAL(10,2)", revenue="DECIMAL(12,2)", unit_price="DECIMAL(10,2)", slg_target="DECIMAL(5,4)",
        date="DATE", order_date="DATE", expected_delivery_date="DATE", actual_delivery_date="DATE",
        on_hand_qty="BIGINT", units_sold="BIGINT", fill_pct="DECIMAL(7,2)",
    )
    for name in ("products", "sales", "inventory", "suppliers", "orders_placed"):
        frame = pd.DataFrame(tables[name]).astype(object)  # noqa: F841 - read by DuckDB
        frame = frame.where(frame.notna(), None)
        for c in ("unit_price", "slg_target", "carrying_cost", "revenue", "fill_pct", "carrying_cost_daily", "days_of_supply",
                  "fill_rate", "on_time_delivery_rate", "min_order_value", "fill_rate_actual"):
            if c in frame:
                frame[c] = frame[c].map(str)
        columns = ", ".join(f'CAST("{c}" AS {casts[c]}) AS "{c}"' if c in casts else f'"{c}"' for c in frame.columns)
        con.execute(f"CREATE OR REPLACE TABLE t_{name} AS SELECT {columns} FROM frame")


# Its SQL counts islands by row number, which needs one row per SKU and day.
ROW_GRAIN = {"longest_stockouts"}


@pytest.mark.parametrize("seed", [3, 11])
def test_reports_on_untidy_tables(spark, make_star, duck, monkeypatch, seed):
    rows = untidy_rows(seed)
    register(duck, rows)
    for name in ("products", "sales", "inventory", "suppliers", "orders_placed"):
        monkeypatch.setitem(base.TABLES, name, f"SELECT * FROM t_{name}")
    monkeypatch.setattr(base, "NEEDS", {})
    sql = reports.build()
    star = make_star(**rows)
    wrong = {}
    for name, report in catalogue.INVENTORY_REPORTS.items():
        if name in ROW_GRAIN:
            continue
        verdict = check.compare(entry_points._comparable(report(star)), sql[name], duck)
        if not verdict.startswith("ok"):
            wrong[name] = verdict
    assert not wrong, "\n".join(f"{k}: {v}" for k, v in wrong.items())


def test_runs_with_several_rows_per_day(make_star):
    inventory = [snapshot("a", n, q) for n, q in enumerate([0, 0, 3, 0, 0, 0, 0, 5, 0])]
    inventory += [snapshot("a", 4, 0), snapshot("a", 6, 2)]  # a repeated empty day; a day both empty and covered
    inventory += [snapshot("orphan", n, 0) for n in range(5)]
    star = make_star(products=[product("a")], inventory=inventory)
    got = [(r.stockout_start, r.stockout_end, r.consecutive_days) for r in stockouts.longest_stockouts(star, min_days=1).collect()]
    # Rows of one day share the running count, so day 6 already belongs to the next run.
    assert got == [(day(3), day(5), 4), (day(0), day(1), 2), (day(6), day(6), 1), (day(8), day(8), 1)]
    assert sum(n for *_, n in got) == sum(q["on_hand_qty"] == 0 for q in inventory if q["sku_id"] == "a")
    assert stockouts.longest_stockouts(star).count() == 1


def test_turns_modes(make_star):
    star = make_star(
        products=[product("a"), product("idle")],
        sales=[sale("a", 0, 10), sale("a", 1, 20)],
        inventory=[snapshot("a", n, 10) for n in range(3)] + [snapshot("idle", 0, 4)],
    )
    pairs = {r.sku_id: r for r in turns.turns_by_sku(star).collect()}
    plain = {r.sku_id: r for r in turns.turns_by_sku(star, mode="grain_safe").collect()}
    assert (pairs["a"].total_units_sold, plain["a"].total_units_sold) == (90, 30)
    assert (float(pairs["a"].inventory_turns), float(plain["a"].inventory_turns)) == (9.0, 3.0)
    assert pairs["idle"].inventory_turns is None and pairs["idle"].days_to_turn is None
    # Ascending with a missing value last, descending with it first.
    assert [r.sku_id for r in turns.slow_movers(star).collect()] == ["a", "idle"]
    assert turns.turns_by_sku(star).first().sku_id == "idle"
    with pytest.raises(ValueError):
        turns.turns_by_sku(star, mode="other")


def test_excess_weeks_needs_more_than_eight(make_star):
    star = make_star(
        products=[product("at"), product("over"), product("unsold")],
        sales=[sale("at", 0, 1), sale("over", 0, 1)],
        inventory=[snapshot("at", 0, 56), snapshot("over", 0, 57), snapshot("unsold", 0, 900)],
    )
    got = overstock.excess_weeks_of_supply(star).collect()
    assert [(r.sku_id, float(r.weeks_of_supply), r.tied_up_capital) for r in got] == [("over", 8.1, 570.0)]


def test_inadequate_safety_stock_deviation(make_star):
    star = make_star(
        products=[product("a", lead_time_days=4)],
        sales=[sale("a", 0, 2), sale("a", 1, 4), sale("a", 1, 9)],
        inventory=[snapshot("a", n, 0) for n in range(21)],
    )
    row = safety_stock.inadequate_safety_stock(star).first()
    # 20 other days plus day 1 counted once per sale.
    assert row.stockout_days == 22 and row.recommended_safety_stock == round(2 * 3.605551 * 2)


def test_supplier_without_orders(make_star):
    star = make_star(
        products=[product("a")], suppliers=[supplier("s1"), supplier("s2")], orders=[order("o1", 0)]
    )
    rows = {r.supplier_id: r for r in suppliers.supplier_performance(star).collect()}
    assert (rows["s2"].total_orders, float(rows["s2"].actual_otd_pct), rows["s2"].actual_avg_lead_time) == (1, 0.0, None)
    score = {r.supplier_id: r for r in suppliers.reliability_score(star).collect()}
    # One order has no deviation: no consistency score, but full marks within the total.
    assert score["s1"].consistency_score is None and score["s1"].overall_reliability_score == 98.5
    assert score["s2"].overall_reliability_score is None
    assert [r.supplier_id for r in suppliers.supplier_scorecard(star).collect()] == ["s1"]


def test_empty_tables_give_empty_or_zero_reports(make_star):
    star = make_star(products=[product("a")])
    assert overstock.overstock_by_month(star).count() == 0
    row = overstock.overstock_by_sku(star).first()
    assert (row.overstock_days, float(row.overstock_rate_pct), row.avg_inventory) == (0, 0.0, None)
    summary = catalogue.INVENTORY_REPORTS["exception_summary"](star).first()
    assert summary.priority_score is None and summary.recommended_action == labels.ACTION_OK
    assert DAY == day(0)


def test_runs_across_months_and_gaps(make_star):
    """Against the running count itself, on random days with holes, whole empty months included."""
    import random

    r = random.Random(9)
    inventory, expected = [], []
    for s in range(6):
        runs, covered, empty_until = {}, 0, -1
        for n in range(200):
            if r.random() < 0.15:
                continue
            if r.random() < 0.02:
                empty_until = n + r.choice([3, 70])
            quantities = [0 if n < empty_until or r.random() < 0.2 else 9 for _ in range(r.choice([1, 1, 2]))]
            covered += sum(q > 0 for q in quantities)
            empty = sum(q == 0 for q in quantities)
            if empty:
                first, _, count = runs.get(covered, (day(n), None, 0))
                runs[covered] = (first, day(n), count + empty)
            inventory += [snapshot(f"k{s}", n, q) for q in quantities]
        expected += [(f"k{s}", *run) for run in runs.values()]
    got = stockouts.stockout_runs(make_star(inventory=inventory).inventory).collect()
    assert sorted(map(tuple, got)) == sorted(expected) and max(e[3] for e in expected) > 40
