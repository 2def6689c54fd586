"""Daily stock ledger: demand, on-hand level, flags, cost and the purchase orders they trigger."""

from __future__ import annotations

import datetime as dt
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import balances
from shelfline.functions.balances import level_pieces, month_starts
from shelfline.functions.dates import DAYS, each_day, end_of
from shelfline.functions.numeric import half_even
from shelfline.plans.facts import days_in, days_with, sum_over_days
from shelfline.sources.buckets import ROWS_PER_BUCKET, bucket_count

START_SHARE = (7, 10)  # the ledger opens at 70% of the maximum level
FALLBACK_DEMAND = 5  # units per day assumed for days of supply on a day without sales
MANY_TASKS, LARGE_TASKS = 64, 16
# A task of two million SKU-days (of eight million beyond ``MANY_TASKS`` tasks) sorts its SKUs' cuts in memory.
IN_MEMORY = ROWS_PER_BUCKET // 4


def daily_demand(sales: DataFrame) -> DataFrame:
    """Units and revenue per SKU and day; bounds every per-SKU series by its calendar."""
    return sales.groupBy("sku_id", "date").agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("sales_rows"),
    )


def sales_bounds(sales: DataFrame) -> tuple[dt.date | None, dt.date | None]:
    """First and last day of the sales, read once; both None without sales."""
    bounds = sales.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    return bounds["first"], bounds["last"]


def calendar_tasks(skus: int, bounds: tuple[dt.date | None, dt.date | None], rows_per_task: int = ROWS_PER_BUCKET) -> int:
    """Tasks for a calendar of ``skus`` x days: first they grow with the rows, beyond
    ``MANY_TASKS`` each of them takes ``LARGE_TASKS`` times as many rows. A calendar of spans is a
    tenth of its days, so such a task is still small. Each of them can be stored as one bucket."""
    first, last = bounds
    rows = skus * ((last - first).days + 1 if first else 0)
    return max(min(MANY_TASKS, bucket_count(rows, rows_per_task)), bucket_count(rows, rows_per_task * LARGE_TASKS))


def _month_starts(bounds: tuple[dt.date | None, dt.date | None]) -> Column:
    starts = month_starts(*bounds)
    return F.array(*[F.lit(day) for day in starts]) if starts else F.lit(None).cast("array<int>")


def _by_sku_and_day(parts: list[DataFrame]) -> DataFrame:
    """Parts that are dealt out on SKU, put together and added up per SKU and day where they are:
    the union keeps the partitioning."""
    columns = [c for c in parts[0].columns if c not in ("sku_id", "day")]
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("sku_id", "day").agg(*[F.sum(c).alias(c) for c in columns])


def demand_on_calendar(
    products: DataFrame, sales: DataFrame, bounds: tuple[dt.date | None, dt.date | None] | None = None
) -> DataFrame:
    """``(sku_id, date, units_sold)`` for every SKU and every day of the sales calendar, 0 where none.

    Days with sales and month starts cut a SKU's calendar into spans. They are told apart per SKU,
    and days are made of them last, so no day of the calendar is shuffled or sorted.
    """
    bounds = bounds or sales_bounds(sales)
    tasks = calendar_tasks(products.count(), bounds, IN_MEMORY)
    demand = daily_demand(sales).where(F.col("sku_id").isNotNull() & F.col("date").isNotNull())
    none = F.lit(0).cast(demand.schema["units_sold"].dataType)
    sold = demand.select("sku_id", F.unix_date("date").alias("day"), F.lit(None).cast("long").alias("copies"), "units_sold")
    listed = products.groupBy("sku_id").agg(F.count(F.lit(1)).alias("copies")).repartition(tasks, "sku_id")
    spine = listed.select("sku_id", F.explode(_month_starts(bounds)).alias("day"), "copies", none.alias("units_sold"))
    by_day = Window.partitionBy("sku_id").orderBy("day")
    cuts = _by_sku_and_day([spine, sold.repartition(tasks, "sku_id")]).select(
        "sku_id", "day", F.coalesce("units_sold", none).alias("units"), F.last("copies", ignorenulls=True).over(by_day).alias("copies"),
        (F.coalesce(F.lead("day").over(by_day), F.unix_date(F.lit(bounds[1]).cast("date")) + 1) - F.col("day")).alias("days"),
    )

    def piece(day: Column, days: Column, units: Column) -> Column:
        return F.struct(day.alias("day"), days.alias("days"), units.alias("units_sold"))

    day, days, units = F.col("day"), F.col("days"), F.col("units")
    pieces = F.when((units == 0) | (days == 1), F.array(piece(day, days, units))).otherwise(
        F.array(piece(day, F.lit(1), units), piece(day + 1, days - 1, none))
    )
    spans = (
        cuts.where("copies is not null")
        .select("sku_id", F.explode(pieces).alias("piece"), "copies")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    number = F.explode(F.sequence(F.lit(0), F.col("piece.days") - 1))
    return spans.select("sku_id", "piece.*", number.alias("number")).select(
        "sku_id", F.date_from_unix_date(F.col("day") + F.col("number")).alias("date"), "units_sold"
    )


def build_ledger(
    products: DataFrame, sales: DataFrame, receipts: DataFrame, bounds: tuple[dt.date | None, dt.date | None] | None = None
) -> DataFrame:
    """The inventory snapshot table: one row per SKU and day of the sales calendar."""
    return each_day(build_spans(products, sales, receipts, bounds))


def build_spans(
    products: DataFrame, sales: DataFrame, receipts: DataFrame, bounds: tuple[dt.date | None, dt.date | None] | None = None
) -> DataFrame:
    """The inventory snapshot table as spans (see ``build_levels``)."""
    return with_measures(build_levels(products, sales, receipts, bounds))


def with_measures(levels: DataFrame) -> DataFrame:
    """Spans with their days of supply and their cost a day, which follow from the other columns."""
    on_hand = F.col("on_hand_qty")
    cost = half_even(on_hand.cast("long") * (F.col("unit_price") * 100).cast("long") * 5, F.lit(1_000_000), 10, 2)
    # Days of supply divides by the day's units, or by the fallback on a day without sales.
    per_day = F.when(F.col("units_sold") > 0, F.col("units_sold")).otherwise(F.lit(FALLBACK_DEMAND))
    return levels.select(
        "date", "sku_id", "on_hand_qty", "units_sold", "reorder_triggered", "stockout_flag", "overstock_flag",
        half_even(on_hand, per_day, 10, 1).alias("days_of_supply"), "safety_stock", "reorder_point", "instock_flag",
        cost.alias("carrying_cost_daily"), DAYS,
    )


def build_levels(
    products: DataFrame, sales: DataFrame, receipts: DataFrame, bounds: tuple[dt.date | None, dt.date | None] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """The inventory snapshot table as spans: a row stands for ``days`` days in a row from ``date``
    on, within one month, on which all other columns are the same; ``with_measures`` adds those that
    follow from them. The rows come in ``tasks`` hash partitions on SKU."""
    bounds = bounds or sales_bounds(sales)
    tasks = tasks or calendar_tasks(products.count(), bounds)
    return levels_of(build_series(products, sales, receipts, bounds, tasks).repartition(tasks, "sku_id"))


def build_series(
    products: DataFrame, sales: DataFrame, receipts: DataFrame, bounds: tuple[dt.date | None, dt.date | None] | None = None,
    tasks: int | None = None, summed: bool = False,
) -> DataFrame:
    """The inventory snapshot table with one row per series of a SKU: its spans as parallel arrays
    (see ``level_pieces``), of which ``levels_of`` makes rows, and what they need of the product. A SKU has
    one series, or the square of its listings if it is listed several times.

    ``receipts`` is ``(sku_id, date, received)``, or has an array ``dates`` for ``date``; ``summed`` says that
    ``sales`` are one row per SKU and day already. The rows lie in
    ``tasks`` hash partitions on SKU, but Spark does not know that of the result of a Python function:
    to add up by SKU they are dealt out once more, as rows with arrays. Stock never goes below zero: demand that
    cannot be served is lost, so on hand is the running balance minus its lowest point below
    zero so far. Days outside the calendar and SKUs that are not in ``products`` are left out.

    Demand and receipts are added up per SKU and day first and gathered per SKU, so a row holds a SKU's
    calendar at most, however many sales it has; days on which nothing moves have
    no entry. A SKU that is listed several times has as many rows a day for each of its listings.
    """
    bounds = bounds or sales_bounds(sales)
    tasks = tasks or calendar_tasks(products.count(), bounds)
    if "dates" not in receipts.columns:
        by_day = receipts.groupBy("sku_id", "date").agg(F.sum("received").alias("received"))
        receipts = by_day.select("sku_id", F.array("date").alias("dates"), "received")
    demand = sales if summed else daily_demand(sales)

    def gathered(df: DataFrame, name: str, *fields: Column) -> DataFrame:
        """One row per SKU, partitioned on it, with its movements in a list."""
        dealt = df.where(F.col("sku_id").isNotNull()).select("sku_id", *fields).repartition(tasks, "sku_id")
        return dealt.groupBy("sku_id").agg(F.collect_list(F.struct(*[c for c in dealt.columns if c != "sku_id"])).alias(name))

    sold = gathered(demand, "sold", F.unix_date("date").alias("day"), F.col("units_sold").cast("long").alias("units"))
    arriving = gathered(receipts, "received", F.col("dates"), F.col("received").cast("long").alias("units"))
    known = ["sku_id", "unit_price", "max_stock_level", "safety_stock", "reorder_point"]
    listed = (
        products.where(F.col("sku_id").isNotNull())
        .select(*known)
        .repartition(tasks, "sku_id")
        .withColumn("copies", F.count(F.lit(1)).over(Window.partitionBy("sku_id")).cast("int"))
        .withColumn("again", F.explode(F.transform(F.sequence(F.lit(1), F.col("copies")), lambda number: number > 1)))
    )
    pieces = level_pieces(bounds)(_start(), F.col("reorder_point"), F.col("again"), F.col("sold"), F.col("received"))
    until = F.date_add(F.lit(bounds[1]).cast("date"), 1).alias("until")
    series = listed.join(sold, "sku_id", "left").join(arriving, "sku_id", "left")
    return series.select(*known, "again", until, pieces.alias("pieces")).select(*known, "again", "until", "pieces.*")


def _start() -> Column:
    return F.call_function("div", F.col("max_stock_level") * START_SHARE[0], F.lit(START_SHARE[1]))


def levels_of(series: DataFrame) -> DataFrame:
    """The spans of ``build_series``, one row each; they stay where the series are."""
    place = F.col("place")
    on_hand = F.when(F.col("max_stock_level").isNotNull(), F.get("levels", place))
    seen = F.when(F.col("again"), on_hand).otherwise(F.coalesce(F.get("levels", place - 1), _start()))
    after = F.coalesce(F.get("firsts", place + 1), F.unix_date("until"))
    return (
        series.withColumnsRenamed({"day": "firsts", "on_hand_qty": "levels", "stockout_flag": "empty"})
        .select("*", F.posexplode("firsts").alias("place", "day"))
        .select(
            F.date_from_unix_date("day").alias("date"), "sku_id", on_hand.alias("on_hand_qty"), F.get("units", place).alias("units_sold"),
            F.when(F.col("max_stock_level").isNotNull(), seen <= F.col("reorder_point")).alias("reorder_triggered"),
            F.when(F.col("max_stock_level").isNotNull(), F.get("empty", place)).alias("stockout_flag"),
            "max_stock_level", "safety_stock", "reorder_point", "unit_price", (after - F.col("day")).alias(DAYS),
        )
        .select(
            "date",
            "sku_id",
            "on_hand_qty",
            "units_sold",
            "reorder_triggered",
            "stockout_flag",
            (F.col("on_hand_qty") > F.col("max_stock_level")).alias("overstock_flag"),
            "safety_stock",
            "reorder_point",
            (~F.col("stockout_flag")).alias("instock_flag"),  # stock is never below zero
            "unit_price",
            DAYS,
        )
    )


def to_columns(series: DataFrame) -> DataFrame:
    """What ``balances.spans_in_columns`` needs of ``build_series``: they are the same
    spans as ``levels_of`` and ``with_measures``, in columns inside a task."""
    return series.select(
        "sku_id", "again", "until", "day", "units", "on_hand_qty", "stockout_flag", "max_stock_level", "safety_stock", "reorder_point",
        _start().alias("start"), (F.col("unit_price") * 100).cast("long").alias("cents"),
    )


def spans_in_columns(series: pa.RecordBatch) -> pa.Table:
    return balances.spans_in_columns(series, FALLBACK_DEMAND)


def triggered_orders(inventory: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """One purchase order per day on which a SKU stood at or below its reorder point.

    Order ids are built from SKU and day: a running number over all orders would need one
    task to see every row. Of spans, the orders of one supplier and SKU that are expected in one
    month are one row: ``DAYS`` orders of ``order_qty`` in all from ``order_date`` to ``last_date``,
    with the id of the last.
    """
    lead_times = products.select("sku_id", "supplier_id", "min_order_qty").join(
        suppliers.select("supplier_id", "avg_lead_time"), "supplier_id"
    )
    wanted = inventory.where("reorder_triggered")
    if DAYS in inventory.columns:
        return _orders_of_spans(wanted.select("sku_id", "date", end_of(inventory).alias("end")).join(lead_times, "sku_id"))
    return (
        wanted.select("sku_id", "date")
        .join(lead_times, "sku_id")
        .select(
            _order_id("date"),
            F.col("date").alias("order_date"),
            "sku_id",
            "supplier_id",
            F.col("min_order_qty").alias("order_qty"),
            F.date_add("date", F.col("avg_lead_time")).alias("expected_delivery_date"),
        )
    )


def _order_id(day: str) -> Column:
    return F.concat_ws("-", F.lit("ORD"), "sku_id", F.date_format(day, "yyyyMMdd")).alias("order_id")


def _orders_of_spans(spans: DataFrame) -> DataFrame:
    """Spans are cut where the month of the expected delivery changes."""
    lead = F.col("avg_lead_time")
    months = spans.withColumns(
        {"first": F.trunc(F.date_add("date", lead), "MM"), "last": F.trunc(F.date_add("end", lead), "MM")}
    ).withColumn(
        "month",
        F.explode(
            F.when(F.col("first").eqNullSafe(F.col("last")), F.array("first"))
            .otherwise(F.sequence("first", "last", F.expr("interval 1 month")))
        ),
    )
    # A bound that is not known, for want of a lead time, is left out by greatest and least.
    cut = months.withColumns(
        {
            "date": F.greatest("date", F.date_sub("month", lead)),
            "end": F.least("end", F.date_sub(F.date_add(F.last_day("month"), 1), lead + 1)),
        }
    ).withColumn("orders", (F.datediff("end", "date") + 1).cast("long"))
    return (
        cut.groupBy("sku_id", "supplier_id", "month")
        .agg(
            F.sum("orders").alias(DAYS), F.sum(F.col("orders") * F.col("min_order_qty")).alias("order_qty"),
            F.min("date").alias("order_date"), F.max("end").alias("last_date"),
        )
        .select(
            _order_id("last_date"), "order_date", "last_date", "sku_id", "supplier_id", "order_qty",
            F.col("month").alias("expected_delivery_date"), DAYS,
        )
    )


def ledger_rollup(inventory: DataFrame) -> DataFrame:
    """Every ledger column added up per SKU and month."""
    return inventory.groupBy("sku_id", F.trunc("date", "MM").alias("month")).agg(
        days_in(inventory).alias("days"),
        sum_over_days(inventory, "on_hand_qty").alias("on_hand_sum"),
        sum_over_days(inventory, "units_sold").alias("units_sold"),
        days_with(inventory, "reorder_triggered").alias("trigger_days"),
        days_with(inventory, "stockout_flag").alias("stockout_days"),
        days_with(inventory, "instock_flag").alias("instock_days"),
        days_with(inventory, "overstock_flag").alias("overstock_days"),
        sum_over_days(inventory, "days_of_supply").alias("days_of_supply_sum"),
        sum_over_days(inventory, "carrying_cost_daily").alias("carrying_cost"),
    )


def triggered_orders_rollup(orders: DataFrame) -> DataFrame:
    """Triggered orders added up per supplier and month of expected delivery."""
    return orders.groupBy("supplier_id", F.trunc("expected_delivery_date", "MM").alias("month")).agg(
        days_with(orders, F.col("order_id").isNotNull()).alias("orders"),
        F.sum("order_qty").alias("order_qty"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_id").alias("last_order_id"),
    )
