"""The inventory by day, written in columns from series or spans: the rows Spark's writer would write."""

import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import day, order, product, sale, supplier, table
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from shelfline import schemas
from shelfline.functions import balances, dates
from shelfline.operators import ledger
from shelfline.sources import months, sinks
from shelfline.sources.shared import new_folder
from shelfline.sources.tables import read_star
from shelfline.star import Star

DAYS = 70


@pytest.fixture(scope="module")
def star(spark):
    """SKUs listed twice, without a highest level, reorder point, price or sales; sales without a day or units."""
    r = random.Random(5)
    names = [f"k{i}" for i in range(12)]
    products = [
        product(s, max_stock_level=r.randint(0, 60), reorder_point=r.randint(0, 40), unit_price=Decimal(r.randint(0, 99999)) / 100)
        for s in [*names, "k4", "k4", "k6"]
    ]
    products[2]["reorder_point"] = products[3]["unit_price"] = products[5]["max_stock_level"] = products[6]["safety_stock"] = None
    products[7]["max_stock_level"] = -7
    sales = [sale(s, r.randrange(DAYS), r.choice([None, 0, r.randint(1, 30)])) for s in names[1:] for _ in range(14)]
    sales += [sale("k5", 0, 3) | {"date": None}, sale("orphan", 0, 2), sale("k1", DAYS - 1, 1), sale("k1", 0, 50)]
    receipts = spark.createDataFrame(
        [(s, r.randint(1, 40), sorted(day(r.randrange(DAYS)) for _ in range(4))) for s in names], "sku_id string, received int, dates array<date>"
    )
    listed, sold = table(spark, schemas.PRODUCTS, products), table(spark, schemas.SALES, sales)
    bounds = ledger.sales_bounds(sold)
    series = ledger.build_series(listed, sold, receipts, bounds, 3)
    levels = ledger.levels_of(series)
    spans = ledger.with_measures(levels)
    return Star(
        listed, table(spark, schemas.SUPPLIERS, [supplier("s1")]), sold, dates.each_day(spans), table(spark, schemas.ORDERS, [order("o", 3)]),
        buckets=3, spans=spans, levels=levels, series=series, calendar=bounds,
    )


def text(df):
    return sorted(map(str, df.collect()))


def files(folder):
    return glob.glob(f"{folder}/fact_inventory/*/*.parquet")


def test_days_of_series_are_written_in_columns(spark, star):
    folder = new_folder(spark, "test")
    counts = {r.table_name: r.rows for r in sinks.write_star(star, folder).collect()}
    wanted = text(star.inventory)
    back = read_star(spark, folder).inventory
    assert counts["fact_inventory"] == len(wanted) == DAYS * (10 + 3 * 3 + 2 * 2)
    assert text(back.drop(dates.PARTITION)) == wanted
    assert back.drop(dates.PARTITION).dtypes == star.inventory.dtypes
    assert back.where(F.col(dates.PARTITION) != F.date_format("date", "yyyy-MM")).count() == 0
    found = files(folder)
    # No day passes Spark's writer, and a task writes one file a month.
    assert {pq.ParquetFile(file).metadata.created_by.split(" ")[0] for file in found} == {"parquet-cpp-arrow"}
    assert len(found) <= 3 * 3


def test_spans_and_other_stores_give_the_same_days(spark, star, monkeypatch):
    wanted = text(star.inventory)
    spans_only = Star(star.products, star.suppliers, star.sales, star.inventory, star.orders, spans=star.spans.localCheckpoint(), buckets=3)
    a, b = new_folder(spark, "test"), new_folder(spark, "test")
    sinks.write_star(spans_only, a)
    monkeypatch.setattr(sinks, "local_path", lambda *_: None)
    before = spark.conf.get(sinks.OPEN_FILES)
    sinks.write_star(star, b)
    assert spark.conf.get(sinks.OPEN_FILES) == before
    made_by = [pq.ParquetFile(files(folder)[0]).metadata.created_by for folder in (a, b)]
    assert "arrow" in made_by[0] and "parquet-mr" in made_by[1]
    one, other = (read_star(spark, folder).inventory for folder in (a, b))
    assert one.schema == other.schema and text(one) == text(other) and text(one.drop(dates.PARTITION)) == wanted


def test_a_second_run_replaces_and_a_failed_one_leaves_the_table(spark, star):
    folder = new_folder(spark, "test")
    for _ in range(2):
        sinks.write_star(star, folder)
    wanted = text(read_star(spark, folder).inventory)
    assert len(wanted) == star.inventory.count()

    def broken(batch):
        raise ValueError("no spans of this")

    kind = star.spans.drop(dates.DAYS).schema
    with pytest.raises(PySparkException):
        months.write_span_days(ledger.to_columns(star.series), f"{folder}/fact_inventory", "date", kind, broken)
    assert text(read_star(spark, folder).inventory) == wanted
    assert not [name for name in os.listdir(folder) if name.startswith(".")]


def test_a_stored_star_is_not_made_again(spark, star):
    stored = sinks.store_by_sku(star, new_folder(spark, "test"))
    assert stored.series is None and stored.levels is None
    folder = new_folder(spark, "test")
    sinks.write_star(stored, folder)
    assert text(read_star(spark, folder).inventory.drop(dates.PARTITION)) == text(star.inventory)


def test_files_of_other_attempts_are_left_out(spark, star):
    """A task that is run again writes under another name; only what the run reports is moved."""
    folder = new_folder(spark, "test")

    def twice(batches):
        return [ledger.spans_in_columns(batch) for batch in batches]

    batches = ledger.to_columns(star.series).toArrow().to_batches()
    staged, kind = f"{folder}-staged", star.spans.drop(dates.DAYS).schema
    write = months._writer(staged, "date", "snappy", {"a": "b"}, ledger.spans_in_columns)
    first, second = (next(write(iter(batches))).column("file").to_pylist() for _ in range(2))
    assert first and not set(first) & set(second) and all(map(os.path.exists, [*first, *second]))
    sinks.write_star(star, folder)
    assert read_star(spark, folder).inventory.count() == star.inventory.count()
    assert kind.names == [f.name for f in pq.read_schema(first[0])]
    assert sum(len(t) for t in twice(batches)) == star.spans.count()


def test_months_of_any_spans():
    """Spans that pass the end of a month are cut there; a span without a day has no month, one without days no row."""
    spans = pa.table({
        "date": pa.array([dt.date(2024, 1, 30), dt.date(2024, 2, 1), None, dt.date(2024, 1, 2), dt.date(2024, 1, 5)], pa.date32()),
        "sku_id": ["a", None, "c", "d", "e"], "n": pa.array([1, None, 3, 4, 5], pa.int32()), "days": pa.array([4, 1, 2, 0, 1], pa.int32()),
    })
    got = {month: rows.to_pylist() for month, rows in months._months(spans, "date")}
    plain = {month: [(r["date"] and r["date"].day, r["sku_id"], r["n"]) for r in rows] for month, rows in got.items()}
    assert plain == {
        "2024-01": [(30, "a", 1), (31, "a", 1), (5, "e", 5)], "2024-02": [(1, "a", 1), (2, "a", 1), (1, None, None)],
        months.NO_MONTH: [(None, "c", 3), (None, "c", 3)],
    }


def test_no_rows_leave_an_empty_table(spark, star):
    folder = new_folder(spark, "test")
    months.write_span_days(star.spans.where("false"), f"{folder}/fact_inventory", "date", star.spans.drop(dates.DAYS).schema)
    assert os.listdir(f"{folder}/fact_inventory") == ["_SUCCESS"]


def test_measures_round_half_to_even_and_stop_above_their_digits():
    series = pa.RecordBatch.from_pydict({
        "sku_id": ["a"], "again": [False], "until": pa.array([day(3)], pa.date32()), "day": pa.array([[balances.day_number(day(n)) for n in range(3)]]),
        "units": [[0, 4, 0]], "on_hand_qty": [[1, 3, 3]], "stockout_flag": [[False] * 3], "max_stock_level": [2], "safety_stock": [1],
        "reorder_point": [1], "start": [1], "cents": [5000],
    })
    spans = ledger.spans_in_columns(series)
    assert spans["days_of_supply"].to_pylist() == [Decimal("0.2"), Decimal("0.8"), Decimal("0.6")]  # 3 / 4 is a half: to the even digit
    assert spans["carrying_cost_daily"].to_pylist() == [Decimal("0.02"), Decimal("0.08"), Decimal("0.08")]  # 2.5 and 7.5 hundredths
    large = series.set_column(series.schema.get_field_index("cents"), "cents", pa.array([10**15]))
    with pytest.raises(OverflowError):
        ledger.spans_in_columns(large)
    assert T.StructType.fromDDL(schemas.INVENTORY)["carrying_cost_daily"].dataType.precision == balances.MEASURE
