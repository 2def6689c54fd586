"""Reporting marts: KPIs, inventory health, sales trends, exceptions, forecasts and heat maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.dates import DAYS, PARTITION, each_day, last_day, on_day, weight
from shelfline.functions.numeric import mean
from shelfline.operators.ledger import daily_demand
from shelfline.plans.facts import (
    PART, days_in, in_parts, inventory_by, inventory_by_sku, month_of, sales_by, sales_by_sku, with_products,
)
from shelfline.star import Star


def year_month(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def _metric_rows(one_row: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """A one-row aggregate to ``(metric, value)`` rows."""
    rows = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value")) for name, value in metrics.items()]
    return one_row.select(F.inline(F.array(*rows)))


def kpi_summary(star: Star, include_inventory_value: bool = False) -> DataFrame:
    """Seven headline metrics, long form; the mean value of a SKU-day's stock is an optional eighth."""
    sold = star.sales.agg(F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units"))
    stock = inventory_by(star.stock)
    parts = [
        _metric_rows(sold, {"Total Revenue": F.col("revenue"), "Total Units Sold": F.col("units")}),
        _metric_rows(
            stock,
            {
                "In-Stock Rate": mean("instock_days", "stock_rows") * 100,
                "Stockout Rate": mean("stockout_days", "stock_rows") * 100,
                "Overstock Rate": mean("overstock_days", "stock_rows") * 100,
                "Total Carrying Cost": F.col("carrying_cost"),
            },
        ),
        _metric_rows(star.products.agg(F.count(F.lit(1)).alias("n")), {"SKU Count": F.col("n")}),
    ]
    formats = dict(labels.KPI_FORMATS)
    if include_inventory_value:
        valued = with_products(inventory_by_sku(star.stock), star.products, "unit_price", how="inner").agg(
            F.sum(F.col("on_hand_sum") * F.col("unit_price")).alias("worth"), F.sum("on_hand_n").alias("n")
        )
        parts.append(_metric_rows(valued, {"Average Inventory Value": mean("worth", "n")}))
        formats["Average Inventory Value"] = "currency"
    shown = F.create_map(*[F.lit(v) for pair in formats.items() for v in pair])
    return reduce(DataFrame.unionByName, parts).withColumn("format", F.element_at(shown, F.col("metric")))


def kpi_strip(star: Star, alerts: DataFrame) -> DataFrame:
    """One row: revenue, units, rates, SKU count, critical alerts and the two traffic lights."""
    critical = _metric_rows(
        alerts.agg(F.count_if(F.col("priority_label") == labels.PRIORITIES[labels.CRITICAL]).alias("n")),
        {"Critical Alerts": F.col("n")},
    )
    metrics = kpi_summary(star).drop("format").unionByName(critical)

    def value(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    row = metrics.agg(
        value("Total Revenue").alias("total_revenue"),
        value("Total Units Sold").cast("long").alias("total_units"),
        value("In-Stock Rate").alias("instock_rate"),
        value("Stockout Rate").alias("stockout_rate"),
        value("SKU Count").cast("long").alias("sku_count"),
        value("Critical Alerts").cast("long").alias("critical_alerts"),
    )
    return row.withColumns(
        {"instock_light": instock_light(F.col("instock_rate")), "stockout_light": stockout_light(F.col("stockout_rate"))}
    )


def instock_light(rate: Column) -> Column:
    return F.when(rate >= 95, "green").when(rate >= 85, "orange").otherwise("red")


def stockout_light(rate: Column) -> Column:
    return F.when(rate > 10, "red").when(rate > 5, "orange").otherwise("green")


def monthly_sales(star: Star) -> DataFrame:
    return (
        sales_by(star.sales, year_month("date").alias("month"))
        .select("month", F.col("revenue_sum").alias("revenue"), F.col("units_sum").alias("units_sold"))
        .orderBy("month")
    )


def inventory_health(star: Star, stock: DataFrame | None = None) -> DataFrame:
    """Every snapshot row (or every row of ``stock``) with its value, safety-stock cover and status.

    The status compares with the product's safety stock, not the one recorded in the snapshot.
    """
    products = star.products.select(
        "sku_id", "product_name", "category", "unit_price",
        F.col("safety_stock").alias("product_safety_stock"), "max_stock_level", "slg_target",
    )
    on_hand, safety = F.col("on_hand_qty"), F.col("product_safety_stock")
    status = (
        F.when(F.col("stockout_flag"), labels.HEALTH_STOCKOUT)
        .when(on_hand < safety, labels.HEALTH_LOW)
        .when(F.col("overstock_flag"), labels.HEALTH_OVERSTOCK)
        .otherwise(labels.HEALTH_OK)
    )
    cover = on_hand.cast("double") / F.when(safety == 0, 1).otherwise(safety) * 100
    return (star.inventory if stock is None else stock).drop(PARTITION).join(products, "sku_id").withColumns(
        {"inventory_value": on_hand * F.col("unit_price"), "safety_stock_pct": cover, "health_status": status}
    )


def inventory_health_rollup(star: Star) -> DataFrame:
    """The health rows counted per SKU, month and status. Values are added up as cents times pieces, in
    two parts that fit longs; months are named last."""
    health = inventory_health(star, star.stock)
    cents = (F.col("unit_price") * 100).cast("long")
    pieces = F.col("on_hand_qty").cast("long") * weight(health)
    return (
        health.groupBy("sku_id", "category", month_of("date").alias("month"), "health_status")
        .agg(
            days_in(health).alias("days"),
            in_parts(pieces * F.call_function("div", cents, F.lit(PART)), pieces * (cents % PART), 2).cast("decimal(31,2)")
            .alias("inventory_value"),
            F.min("safety_stock_pct").alias("min_safety_stock_pct"),
            F.max("safety_stock_pct").alias("max_safety_stock_pct"),
        )
        .withColumn("month", year_month("month"))
    )


def daily_health(star: Star) -> DataFrame:
    """Stock, value, exception counts, in-stock share and cost per day and category."""
    priced = star.products.select("sku_id", "category", "unit_price")
    if star.spans is not None:
        return _daily_health_of_spans(star.spans.join(priced, "sku_id"))
    return (
        star.inventory.join(priced, "sku_id")
        .groupBy("date", "category")
        .agg(
            F.sum("on_hand_qty").alias("total_units"),
            F.sum(F.col("on_hand_qty") * F.col("unit_price")).alias("total_value"),
            F.count_if("stockout_flag").alias("stockout_skus"),
            F.count_if("overstock_flag").alias("overstock_skus"),
            mean(F.count_if("instock_flag"), F.count("instock_flag")).alias("instock_rate"),
            F.sum("carrying_cost_daily").alias("carrying_cost"),
        )
    )


def _daily_health_of_spans(stock: DataFrame) -> DataFrame:
    """A span adds to its category on its first day and takes the same away after its last; running
    sums over the days of such changes give every day. A category has at most one row per calendar
    day when it is sorted, and days are made of its rows, not of the spans."""
    on_hand = F.col("on_hand_qty")
    sums = {
        "total_units": on_hand.cast("long"),
        "total_value": on_hand * F.col("unit_price"),
        "carrying_cost": F.col("carrying_cost_daily"),
    }
    counts = {
        "rows": F.lit(True),
        "stockout_skus": F.col("stockout_flag"),
        "overstock_skus": F.col("overstock_flag"),
        "instock_skus": F.col("instock_flag"),
        "instock_n": F.col("instock_flag").isNotNull(),
        **{f"{name}_n": value.isNotNull() for name, value in sums.items()},
    }
    after = F.date_add("date", F.col(DAYS)).alias("date")
    change = [F.struct(day, F.lit(sign).alias("sign")) for day, sign in ((F.col("date"), 1), (after, -1))]
    changes = (
        stock.select("category", *[value.alias(name) for name, value in (sums | counts).items()], F.inline(F.array(*change)))
        .groupBy("category", "date")
        .agg(
            *[F.sum(F.when(F.col("sign") > 0, F.col(name)).otherwise(-F.col(name))).alias(name) for name in sums],
            *[F.coalesce(F.sum(F.when(F.col(name), F.col("sign"))), F.lit(0)).alias(name) for name in counts],
        )
    )
    by_day = Window.partitionBy("category").orderBy("date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = changes.select(
        "category", "date", F.datediff(F.lead("date").over(by_day), "date").alias(DAYS),
        *[F.sum(name).over(so_far).alias(name) for name in [*sums, *counts]],
    ).where("rows > 0")

    def total(name: str) -> Column:
        return F.when(F.col(f"{name}_n") > 0, F.col(name).cast(changes.schema[name].dataType)).alias(name)

    return each_day(levels).select(
        "date", "category", total("total_units"), total("total_value"), "stockout_skus", "overstock_skus",
        mean("instock_skus", "instock_n").alias("instock_rate"), total("carrying_cost"),
    )


def sales_detail(star: Star) -> DataFrame:
    """Sales rows with product columns (the product's category wins), month, ISO week and weekday."""
    products = star.products.select("sku_id", "product_name", "brand", "category", "sub_category")
    return star.sales.drop("category", PARTITION).join(products, "sku_id").withColumns(
        {
            "month": year_month("date"),
            "week": F.weekofyear("date"),
            "day_of_week": F.date_format("date", "EEEE"),
        }
    )


def daily_sales_by_category(star: Star) -> DataFrame:
    """One row per SKU and day before the join: a SKU with many sales reaches it as few rows."""
    return (
        daily_demand(star.sales)
        .join(star.products.select("sku_id", "category"), "sku_id")
        .groupBy("date", "category")
        .agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
    )


def monthly_trend_by_category(star: Star) -> DataFrame:
    """Sales per month and category with the number of SKUs sold; one row per SKU and month
    before the join, so that number is a plain count."""
    per_sku = sales_by(star.sales, "sku_id", year_month("date").alias("month"))
    return (
        per_sku.join(star.products.select("sku_id", "category"), "sku_id")
        .groupBy("month", "category")
        .agg(
            F.sum("units_sum").alias("units_sold"),
            F.sum("revenue_sum").alias("revenue"),
            F.count("sku_id").alias("active_skus"),
        )
    )


def top_products(star: Star, top: int = 50) -> DataFrame:
    return (
        with_products(sales_by_sku(star.sales), star.products, "product_name", "category", how="inner")
        .select("sku_id", "product_name", "category", F.col("units_sum").alias("units_sold"),
                F.col("revenue_sum").alias("revenue"))
        .orderBy(F.desc("revenue"), "sku_id")
        .limit(top)
    )


def exception_mart(star: Star) -> DataFrame:
    """Alerts with their category; without an alert table, or with an empty one, the exceptions of
    the last inventory day. The two have different columns, so a one-row check comes first."""
    if star.alerts is not None and not star.alerts.isEmpty():
        return star.alerts.join(star.products.select("sku_id", "category"), "sku_id", "left")
    last = on_day(star.stock, last_day(star.stock))
    kind = (
        F.when(F.col("stockout_flag"), labels.HEALTH_STOCKOUT)
        .when(F.col("on_hand_qty") < F.col("safety_stock"), labels.HEALTH_LOW)
        .when(F.col("overstock_flag"), labels.HEALTH_OVERSTOCK)
    )
    return (
        last.withColumn("exception_type", kind)
        .where(F.col("exception_type").isNotNull())
        .join(star.products.select("sku_id", "product_name", "category"), "sku_id")
        .select("sku_id", "product_name", "category", "exception_type", "on_hand_qty", "safety_stock", "reorder_point")
    )


def forecast_mart(star: Star) -> DataFrame | None:
    """Forecast rows with product columns and predicted revenue; None without a forecast table."""
    if star.forecasts is None:
        return None
    products = star.products.select("sku_id", "product_name", "category", "unit_price")
    return star.forecasts.join(products, "sku_id").withColumn(
        "predicted_revenue", F.col("predicted_demand") * F.col("unit_price").cast("double")
    )


def category_totals(star: Star) -> DataFrame:
    return (
        with_products(sales_by_sku(star.sales), star.products, "category", how="inner")
        .groupBy("category")
        .agg(F.sum("revenue_sum").alias("revenue"), F.sum("units_sum").alias("units_sold"))
        .orderBy(F.asc_nulls_last("revenue"), "category")
    )


def _sku_months(star: Star) -> DataFrame:
    monthly = inventory_by(star.stock, "sku_id", year_month("date").alias("month"))
    return monthly.join(star.products.select("sku_id", "category"), "sku_id")


def monthly_instock_by_category(star: Star) -> DataFrame:
    return (
        _sku_months(star)
        .groupBy("month", "category")
        .agg((mean(F.sum("instock_days"), F.sum("stock_rows")) * 100).alias("instock_pct"))
    )


def daily_instock_by_category(star: Star) -> DataFrame:
    return daily_health(star).select("date", "category", (F.col("instock_rate") * 100).alias("instock_rate_pct"))


def stockout_heatmap(star: Star) -> DataFrame:
    """``(category, month, stockout_days)`` for every category and every month of the inventory,
    0 where there are none."""
    counted = _sku_months(star).groupBy("category", "month").agg(F.sum("stockout_days").alias("days"))
    span = star.stock.agg(F.struct(F.trunc(F.min("date"), "MM").alias("first"), F.trunc(F.max("date"), "MM").alias("last"))).scalar()
    months = F.transform(
        F.sequence(F.col("span.first"), F.col("span.last"), F.expr("interval 1 month")), lambda day: F.date_format(day, "yyyy-MM")
    )
    cells = counted.select("category").distinct().withColumn("span", span).select(
        F.col("category").alias("row"), F.explode(months).alias("column")
    )
    matched = F.col("row").eqNullSafe(F.col("category")) & (F.col("column") == F.col("month"))
    return cells.join(counted, matched, "left").select(
        F.col("row").alias("category"), F.col("column").alias("month"), F.coalesce("days", F.lit(0)).alias("stockout_days")
    )


def months_as_columns(heatmap: DataFrame) -> DataFrame:
    """The heat map with one column per month, for display."""
    return heatmap.groupBy("category").pivot("month").sum("stockout_days")


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts by priority and by type, one row per priority or type."""
    return (
        alerts.select(
            F.inline(
                F.array(
                    F.struct(F.lit("priority").alias("dimension"), F.col("priority_label").alias("label")),
                    F.struct(F.lit("type").alias("dimension"), F.col("alert_type").alias("label")),
                )
            )
        )
        .groupBy("dimension", "label")
        .agg(F.count(F.lit(1)).alias("alerts"))
    )


def cluster_display(clusters: DataFrame) -> DataFrame:
    """Cluster rows made fit for a chart: text that is no number counts as missing."""

    def number(column: str, missing: float) -> Column:
        value = F.col(column).cast("string").try_cast("double")
        return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(missing))

    return clusters.withColumns(
        {
            "avg_daily_demand": number("avg_daily_demand", 0.0),
            "total_revenue": number("total_revenue", 0.0),
            "inventory_turns": number("inventory_turns", 1.0),
        }
    ).withColumn("size_value", F.least(F.col("inventory_turns"), F.lit(100.0)))
