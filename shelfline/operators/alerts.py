"""Exception alerts: six detectors over the look-back window, one unified record."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import labels
from shelfline.functions.dates import last_day, on_day, since
from shelfline.functions.numeric import mean, moments, sample_deviation
from shelfline.operators.stockouts import stockout_runs
from shelfline.plans.facts import days_in, days_with
from shelfline.schemas import ALERTS
from shelfline.star import Star


@dataclass(frozen=True)
class Thresholds:
    stockout_days_critical: int = 7
    stockout_days_high: int = 3
    low_stock_pct: float = 0.5
    overstock_pct: float = 1.5
    slg_breach_pct: float = 0.05
    demand_spike_std: float = 2.0
    supplier_delay_days: int = 3
    supplier_delay_days_high: int = 7
    lookback_days: int = 30


def _named(products: DataFrame, *columns: str) -> DataFrame:
    name = F.substring("product_name", 1, labels.ALERT_NAME_LENGTH)
    return products.select("sku_id", name.alias("product_name"), *columns)


def _known_name() -> Column:
    return F.coalesce("product_name", F.lit("Unknown")).alias("product_name")


def _alert(kind: str, priority: Column, message: Column, action: Column, *details: Column | str) -> list:
    return [
        F.lit(kind).alias("alert_type"), "sku_id", priority.alias("priority"), message.alias("message"),
        action.alias("action"), *details,
    ]


def stockout_alerts(inventory: DataFrame, products: DataFrame, t: Thresholds = Thresholds(),
                    consecutive: bool = False) -> DataFrame:
    """Days without stock in the window: all of them, or the longest unbroken run."""
    if consecutive:
        days = stockout_runs(inventory).groupBy("sku_id").agg(F.max("consecutive_days").alias("stockout_days"))
    else:
        days = inventory.where("stockout_flag").groupBy("sku_id").agg(days_in(inventory).alias("stockout_days"))
    critical = F.col("stockout_days") >= t.stockout_days_critical
    return (
        days.where(F.col("stockout_days") >= t.stockout_days_high)
        .join(_named(products), "sku_id", "left")
        .select(
            *_alert(
                "STOCKOUT",
                F.when(critical, labels.CRITICAL).otherwise(labels.HIGH),
                F.format_string(
                    "%s: %d days without inventory",
                    F.when(critical, "Critical stockout").otherwise("Stockout alert"), "stockout_days",
                ),
                F.when(critical, labels.ALERT_ACTIONS["STOCKOUT_CRITICAL"])
                .otherwise(labels.ALERT_ACTIONS["STOCKOUT_HIGH"]),
                _known_name(), "stockout_days",
            )
        )
    )


def low_stock_alerts(latest: DataFrame, products: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Below a share of the safety stock recorded with the snapshot."""
    return (
        latest.where(F.col("on_hand_qty") < F.col("safety_stock") * t.low_stock_pct)
        .select("sku_id", F.col("on_hand_qty").cast("long").alias("current_qty"), "safety_stock")
        .join(_named(products), "sku_id", "left")
        .select(
            *_alert(
                "LOW_STOCK", F.lit(labels.HIGH),
                F.format_string("Inventory critically low: %d units (safety stock: %d)", "current_qty", "safety_stock"),
                F.lit(labels.ALERT_ACTIONS["LOW_STOCK"]),
                _known_name(), "current_qty", "safety_stock",
            )
        )
    )


def overstock_alerts(latest: DataFrame, products: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Above a multiple of the maximum level; SKUs without a product are skipped."""
    return (
        latest.select("sku_id", F.col("on_hand_qty").cast("long").alias("current_qty"))
        .join(_named(products, F.col("max_stock_level").alias("max_level")), "sku_id")
        .where(F.col("current_qty") > F.col("max_level") * t.overstock_pct)
        .select(
            *_alert(
                "OVERSTOCK", F.lit(labels.MEDIUM),
                F.format_string("Excess inventory: %d units (max: %d)", "current_qty", "max_level"),
                F.lit(labels.ALERT_ACTIONS["OVERSTOCK"]),
                "product_name", "current_qty", "max_level",
                (F.col("current_qty") - F.col("max_level")).alias("excess_units"),
            )
        )
    )


def service_level_alerts(inventory: DataFrame, products: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    rate, target = F.col("rate"), F.col("slg_target").cast("double")
    actual_pct, target_pct = F.bround(rate * 100, 1), F.bround(target * 100, 1)
    return (
        inventory.where(F.col("sku_id").isNotNull())
        .groupBy("sku_id")
        .agg(mean(days_with(inventory, "instock_flag"), days_with(inventory, F.col("instock_flag").isNotNull())).alias("rate"))
        .join(_named(products, "slg_target"), "sku_id")
        .where(rate < target - t.slg_breach_pct)
        .select(
            *_alert(
                "SLG_BREACH", F.lit(labels.HIGH),
                F.format_string("Service level below target: %.1f%% vs %.1f%% target", actual_pct, target_pct),
                F.lit(labels.ALERT_ACTIONS["SLG_BREACH"]),
                "product_name", actual_pct.alias("actual_slg"), target_pct.alias("target_slg"),
                F.bround((target - rate) * 100, 1).alias("gap_pct"),
            )
        )
    )


def demand_spike_alerts(sales: DataFrame, products: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Last sales day far above the window's mean; that day counts towards mean and deviation."""
    stats = (
        sales.where(F.col("sku_id").isNotNull())
        .groupBy("sku_id")
        .agg(*moments("units_sold", "units"))
        .select("sku_id", mean("units_sum", "units_n").alias("avg"),
                sample_deviation("units_sum", "units_squares", "units_n").alias("std"))
        .where("std > 0")
    )
    return (
        on_day(sales, last_day(sales))
        .select("sku_id", F.col("units_sold").cast("long").alias("current_demand"))
        .join(stats, "sku_id")
        .where(F.col("current_demand") > F.col("avg") + F.col("std") * t.demand_spike_std)
        .join(_named(products), "sku_id", "left")
        .select(
            *_alert(
                "DEMAND_SPIKE", F.lit(labels.MEDIUM),
                F.format_string("Unusual demand spike: %d units (avg: %.1f)", "current_demand", F.bround("avg", 1)),
                F.lit(labels.ALERT_ACTIONS["DEMAND_SPIKE"]),
                _known_name(), "current_demand", F.bround("avg", 1).alias("avg_demand"),
                F.bround("std", 1).alias("std_demand"),
            )
        )
    )


def supplier_delay_alerts(orders: DataFrame, products: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    late = F.datediff("actual_delivery_date", "expected_delivery_date")
    return (
        orders.withColumn("days_late", late)
        .where((F.col("days_late") > 0) & (F.col("days_late") >= t.supplier_delay_days))
        .select("sku_id", "order_id", "supplier_id", "days_late")
        .join(_named(products), "sku_id", "left")
        .select(
            *_alert(
                "SUPPLIER_DELAY",
                F.when(F.col("days_late") >= t.supplier_delay_days_high, labels.HIGH).otherwise(labels.MEDIUM),
                F.format_string("Supplier delivery %d days late", "days_late"),
                F.lit(labels.ALERT_ACTIONS["SUPPLIER_DELAY"]),
                _known_name(), "order_id", "supplier_id", "days_late",
            )
        )
    )


def _as_records(alerts: DataFrame, as_of: Column) -> DataFrame:
    """The fixed alert schema; details a detector does not have are NULL."""
    names = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.PRIORITIES.items())])
    filled = alerts.withColumns(
        {
            "priority_label": F.coalesce(F.try_element_at(names, F.col("priority")), F.lit("UNKNOWN")),
            "timestamp": as_of,
        }
    )
    return filled.select(
        *[
            (F.col(f.name) if f.name in filled.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(ALERTS)
        ]
    )


def detect_alerts(star: Star, t: Thresholds = Thresholds(), as_of: Column | None = None,
                  consecutive: bool = False) -> DataFrame:
    """All alerts of the look-back window, which ends on the last inventory day.

    The last day is a one-value subquery. Date filters name the partition column of stored facts
    too, so only the months of the window are read.
    """
    today = last_day(star.stock)
    cutoff = F.date_sub(today, t.lookback_days)
    inventory = since(star.stock, cutoff)
    last = on_day(star.stock, today)
    found = [
        stockout_alerts(inventory, star.products, t, consecutive),
        low_stock_alerts(last, star.products, t),
        overstock_alerts(last, star.products, t),
        service_level_alerts(inventory, star.products, t),
        demand_spike_alerts(since(star.sales, cutoff), star.products, t),
        supplier_delay_alerts(since(star.orders, cutoff, "order_date"), star.products, t),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    return _as_records(every, F.current_timestamp() if as_of is None else as_of)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts in total (both keys NULL), by priority and by type, in one pass."""
    return alerts.groupingSets(
        [["priority_label"], ["alert_type"], []], "priority_label", "alert_type"
    ).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("priority") == labels.CRITICAL).alias("critical"),
        F.count_if(F.col("priority") == labels.HIGH).alias("high"),
    )


def urgent_alerts(alerts: DataFrame, top: int = 10) -> DataFrame:
    """The most urgent critical and high alerts."""
    return (
        alerts.where(F.col("priority") <= labels.HIGH)
        .orderBy("priority", "alert_type", "sku_id", "message", "order_id")
        .limit(top)
        .select("priority_label", "alert_type", "sku_id", "message", "action")
    )
