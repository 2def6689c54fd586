"""Pre-aggregations the reports share.

Every report first reduces a fact table to one row per SKU, supplier, month or SKU-day, with
map-side partial sums, and only then joins the small result to the dimensions. A key that holds
a large share of the rows therefore reaches the shuffle as one row per map task. Measures that
a report does not use are pruned by the optimizer.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shelfline.functions.dates import DAYS, each_day, weight
from shelfline.functions.numeric import flag_count, moments, wide
from shelfline.star import Star


SHORT = 12  # digits of a decimal that times a number of days is within a long
PART = 1_000_000


def month_of(day: str) -> Column:
    return F.trunc(day, "MM")


def days_in(df: DataFrame) -> Column:
    """The number of days that the rows of a group stand for."""
    return F.coalesce(F.sum(weight(df).cast("long")), F.lit(0)) if DAYS in df.columns else F.count(F.lit(1))


def days_with(df: DataFrame, condition: Column | str) -> Column:
    """The days of a group's rows on which a condition is true (0, never NULL)."""
    if DAYS not in df.columns:
        return flag_count(condition)
    true = F.col(condition) if isinstance(condition, str) else condition
    return F.coalesce(F.sum(F.when(true, weight(df).cast("long"))), F.lit(0))


def sum_over_days(df: DataFrame, column: str) -> Column:
    """The sum of a daily column; whole numbers as longs, decimals with as many digits as a plain sum."""
    if DAYS not in df.columns:
        return F.sum(column)
    kind = df.schema[column].dataType
    if isinstance(kind, DecimalType):
        return _times(column, kind, weight(df)).cast(f"decimal({min(38, kind.precision + 10)},{kind.scale})")
    return F.sum(F.col(column).cast("long") * weight(df))


def _times(column: str, kind: DecimalType, rows: Column) -> Column:
    """The exact sum of a decimal column, every value counted ``rows`` times. Short decimals are added up as
    whole numbers of their last digit, in two parts that fit longs."""
    if kind.precision > SHORT:
        return F.sum((F.col(column) * rows).cast(f"decimal({min(28, kind.precision + 4)},{kind.scale})"))
    units = (F.col(column) * 10**kind.scale).cast("long") * rows.cast("long")
    return in_parts(F.call_function("div", units, F.lit(PART)), units % PART, kind.scale)


def in_parts(high: Column, low: Column, scale: int) -> Column:
    """The sum of ``high * PART + low``, longs, as a decimal of that many units of its last digit."""
    whole = F.sum(high).cast("decimal(22,0)") * PART + F.sum(low).cast("decimal(20,0)")
    return whole.cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-scale))


def inventory_by(inventory: DataFrame, *keys: Column | str) -> DataFrame:
    return inventory.groupBy(*keys).agg(
        days_in(inventory).alias("stock_rows"),
        days_with(inventory, "instock_flag").alias("instock_days"),
        days_with(inventory, "stockout_flag").alias("stockout_days"),
        days_with(inventory, "overstock_flag").alias("overstock_days"),
        sum_over_days(inventory, "on_hand_qty").alias("on_hand_sum"),
        days_with(inventory, F.col("on_hand_qty").isNotNull()).alias("on_hand_n"),
        sum_over_days(inventory, "carrying_cost_daily").alias("carrying_cost"),
    )


def inventory_by_sku(inventory: DataFrame) -> DataFrame:
    return inventory_by(inventory.where(F.col("sku_id").isNotNull()), "sku_id")


def sales_by(sales: DataFrame, *keys: Column | str) -> DataFrame:
    return sales.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sales_rows"),
        *moments("units_sold", "units"),
        F.sum("revenue").alias("revenue_sum"),
    )


def sales_by_sku(sales: DataFrame) -> DataFrame:
    return sales_by(sales.where(F.col("sku_id").isNotNull()), "sku_id")


def orders_by(orders: DataFrame, *keys: Column | str) -> DataFrame:
    on_time = F.col("actual_delivery_date") <= F.col("expected_delivery_date")
    late = F.datediff("actual_delivery_date", "expected_delivery_date")
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.count("order_id").alias("order_ids"),
        F.sum("order_qty").alias("order_qty"),
        *moments("lead_time_actual", "lead"),
        F.sum("fill_rate_actual").alias("fill_sum"),
        F.count("fill_rate_actual").alias("fill_n"),
        F.count_if(on_time).alias("on_time_rows"),
        F.sum(late).alias("late_sum"),
        F.count(late).alias("late_n"),
    )


DAY_MEASURES = ("sales_rows", "units_sum", "units_n", "units_squares", "revenue_sum")


def sales_of_sku(sales: DataFrame) -> DataFrame:
    """``(sku_id, by_day)``: a map from days with sales to the day's sums. Bounded by the calendar."""
    days = sales_by(sales.where(F.col("sku_id").isNotNull() & F.col("date").isNotNull()), "sku_id", "date")
    entries = F.collect_list(F.struct("date", F.struct(*DAY_MEASURES)))
    return days.groupBy("sku_id").agg(F.map_from_entries(entries).alias("by_day"))


def stock_with_day_sales(star: Star) -> DataFrame:
    """The inventory rows of a SKU, each with the sums of its day's sales (NULL without any)."""
    stock = star.inventory.where(F.col("sku_id").isNotNull())
    if star.sales_of_sku is None:
        return stock.join(sales_by(star.sales, "sku_id", "date"), ["sku_id", "date"], "left")
    with_map = star.stock.where(F.col("sku_id").isNotNull()).join(star.sales_of_sku(), "sku_id", "left")
    if DAYS in with_map.columns:
        with_map = each_day(with_map)
    looked_up = with_map.withColumn("day", F.try_element_at("by_day", F.col("date"))).drop("by_day")
    return looked_up.select("*", "day.*").drop("day")


def stock_and_sales_by_sku(star: Star) -> DataFrame:
    """Per SKU, the measures of inventory left-joined to sales on SKU and day.

    Sales are reduced to one row per SKU-day first, so the join never multiplies rows; each
    measure is weighted by the number of matching rows on the other side, which is what the
    plain row-by-row join would have counted. Where the star carries stored sales of each SKU, a
    stock row looks its day up there: both tables are bucketed on SKU, so neither is shuffled.
    Otherwise both are shuffled on SKU and day, which spreads one SKU's rows over all tasks. Spans that
    are cut at sales are not made into days: only their first day can have any.
    """
    if star.cut_at_sales and star.spans is not None and star.sales_of_sku is not None:
        return _spans_and_sales_by_sku(star)
    joined = stock_with_day_sales(star)
    copies = F.coalesce("sales_rows", F.lit(1))
    stock = F.col("on_hand_qty")
    return joined.groupBy("sku_id").agg(
        F.sum(copies).alias("stock_rows"),
        F.sum(F.when(F.col("instock_flag"), copies).otherwise(0)).alias("instock_days"),
        F.sum(F.when(F.col("stockout_flag"), copies).otherwise(0)).alias("stockout_days"),
        F.sum(F.when(F.col("overstock_flag"), copies).otherwise(0)).alias("overstock_days"),
        F.sum(stock * copies).alias("on_hand_sum"),
        F.sum(F.when(stock.isNotNull(), copies).otherwise(0)).alias("on_hand_n"),
        F.sum(F.col("carrying_cost_daily") * copies).alias("carrying_cost"),
        F.sum("units_sum").alias("units_sum"),
        F.coalesce(F.sum("units_n"), F.lit(0)).alias("units_n"),
        F.sum("units_squares").alias("units_squares"),
        F.sum("revenue_sum").alias("revenue_sum"),
    )


def _spans_and_sales_by_sku(star: Star) -> DataFrame:
    spans = star.spans.where(F.col("sku_id").isNotNull()).join(star.sales_of_sku(), "sku_id", "left")
    joined = spans.withColumn("day", F.try_element_at("by_day", F.col("date"))).drop("by_day").select("*", "day.*")
    # The rows of the plain join: those of the first day's sales, and one on each of the other days.
    joined = joined.withColumn("rows", F.coalesce("sales_rows", F.lit(1)) + F.col(DAYS) - 1)
    rows, stock = F.col("rows"), F.col("on_hand_qty")
    return joined.groupBy("sku_id").agg(
        F.sum(rows).alias("stock_rows"),
        F.sum(F.when(F.col("instock_flag"), rows).otherwise(0)).alias("instock_days"),
        F.sum(F.when(F.col("stockout_flag"), rows).otherwise(0)).alias("stockout_days"),
        F.sum(F.when(F.col("overstock_flag"), rows).otherwise(0)).alias("overstock_days"),
        F.sum(stock * rows).alias("on_hand_sum"),
        F.sum(F.when(stock.isNotNull(), rows).otherwise(0)).alias("on_hand_n"),
        _times("carrying_cost_daily", star.spans.schema["carrying_cost_daily"].dataType, rows).cast("decimal(38,2)").alias("carrying_cost"),
        F.sum("units_sum").alias("units_sum"),
        F.coalesce(F.sum("units_n"), F.lit(0)).alias("units_n"),
        F.sum("units_squares").alias("units_squares"),
        F.sum("revenue_sum").alias("revenue_sum"),
    )


def all_pairs_measures(inventory: DataFrame, sales: DataFrame, how: str) -> DataFrame:
    """Per SKU, the measures of sales joined to inventory on SKU alone, without the join.

    Joining every sale of a SKU to every one of its stock days repeats each sale once per stock
    day and each stock day once per sale. The same sums follow from the two row counts, so the
    two facts are only joined after both are down to one row per SKU. ``how`` is ``left`` when
    a SKU missing on one side still counts its rows once, ``inner`` when it counts for nothing.
    """
    sold, stock = sales_by_sku(sales), inventory_by_sku(inventory)
    both = sold.join(stock, "sku_id", "full" if how == "left" else "inner")
    sale_rows = wide(F.greatest(F.coalesce("sales_rows", F.lit(0)), F.lit(1)))
    stock_rows = wide(F.greatest(F.coalesce("stock_rows", F.lit(0)), F.lit(1)))
    return both.select(
        "sku_id",
        (wide("units_sum") * stock_rows).alias("pair_units"),
        (wide("on_hand_sum") * sale_rows).alias("pair_on_hand"),
        (wide("on_hand_n") * sale_rows).alias("pair_on_hand_n"),
    )


def with_products(measures: DataFrame, products: DataFrame, *columns: str, how: str = "left") -> DataFrame:
    """Product rows with their per-SKU measures; ``left`` keeps products without any."""
    return products.select("sku_id", *columns).join(measures, "sku_id", how)


def joined_rows(count: str) -> Column:
    """Row count of a left join seen from the kept side: an unmatched row counts as one."""
    return F.coalesce(F.col(count), F.lit(1))


def or_zero(measure: str) -> Column:
    return F.coalesce(F.col(measure), F.lit(0))
