"""Date filters that prune: stored facts are partitioned by ``PARTITION``, the month of their day.

A table may hold spans instead of days: a row with ``DAYS`` stands for that many days from its day
on, all within one month. The filters here cut spans; ``weight`` is what a row counts for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION = "fact_month"
DAYS = "days"


def partition_of(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def weight(df: DataFrame) -> Column:
    """The days that a row stands for."""
    return F.col(DAYS) if DAYS in df.columns else F.lit(1)


def end_of(df: DataFrame, day: str = "date") -> Column:
    """The last day that a row stands for."""
    return F.date_add(day, F.col(DAYS) - 1) if DAYS in df.columns else F.col(day)


def each_day(spans: DataFrame, day: str = "date") -> DataFrame:
    """One row per day of every span, without ``DAYS``."""
    number = F.explode(F.sequence(F.lit(0), F.col(DAYS) - 1))
    return spans.withColumn("_number", number).withColumn(day, F.date_add(day, F.col("_number"))).drop("_number", DAYS)


def last_day(df: DataFrame, day: str = "date") -> Column:
    """The last day as a one-value subquery. On a stored fact only the last month is read for it:
    the last month is found from the partition column alone."""
    if PARTITION in df.columns:
        df = df.where(F.col(PARTITION) == df.agg(F.max(PARTITION)).scalar())
    return df.agg(F.max(end_of(df, day))).scalar()


def since(df: DataFrame, first: Column, day: str = "date") -> DataFrame:
    """Rows from ``first`` on."""
    rows = df.where(end_of(df, day) >= first)
    if DAYS in df.columns:
        missed = F.greatest(F.datediff(first, day), F.lit(0))
        rows = rows.withColumn("_missed", missed).withColumns(
            {day: F.date_add(day, F.col("_missed")), DAYS: F.col(DAYS) - F.col("_missed")}
        ).drop("_missed")
    return rows.where(F.col(PARTITION) >= partition_of(first)) if PARTITION in df.columns else rows


def on_day(df: DataFrame, when: Column, day: str = "date") -> DataFrame:
    rows = df.where(F.col(day) == when) if DAYS not in df.columns else (
        df.where((F.col(day) <= when) & (end_of(df, day) >= when)).withColumn(day, when).drop(DAYS)
    )
    return rows.where(F.col(PARTITION) == partition_of(when)) if PARTITION in df.columns else rows
