"""Exact quantiles of a distributed column, by selection on digits."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 4096
FEW = 10_000


@dataclass
class _Range:
    """The values from ``low`` to ``high``: how many rows come before them, and how many they are."""

    low: float
    high: float
    before: int
    rows: int

    def settled(self, few: int) -> bool:
        return self.low == self.high or self.rows <= few


def _place(v: Column, r: _Range, digits: int) -> Column:
    """The leading digit of a value's place within a range, in base ``digits``."""
    return F.least(F.floor((v - r.low) / (r.high - r.low) * digits), F.lit(digits - 1)).cast("int")


def _refine(values: DataFrame, ranges: list[_Range], ranks: list[int], digits: int) -> list[_Range]:
    """The cells of ``ranges`` that hold a wanted rank, from the row counts of all their cells."""
    v = F.col("v")
    number, digit = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        inside = v.between(r.low, r.high)
        number, digit = F.when(inside, i).otherwise(number), F.when(inside, _place(v, r, digits)).otherwise(digit)
    cells = (
        values.select(number.alias("r"), digit.alias("d"), "v").where("r is not null").groupBy("r", "d")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    )
    found, before = [], {i: r.before for i, r in enumerate(ranges)}
    for cell in sorted(cells, key=lambda c: (c["r"], c["d"])):
        start = before[cell["r"]]
        before[cell["r"]] += cell["n"]
        if any(start <= rank < start + cell["n"] for rank in ranks):
            found.append(_Range(cell["low"], cell["high"], start, cell["n"]))
    return found


def exact_quantiles(df: DataFrame, column: str, shares: list[float], few: int = FEW, digits: int = DIGITS) -> DataFrame:
    """One row ``(share, value)`` per share, with linear interpolation between neighbours; none for
    a column without values.

    The range of the values is cut into ``digits`` equal cells, whose rows are counted in one pass
    with partial sums; only the cells that hold a wanted rank are cut again, until a cell has one
    value or at most ``few`` rows, which are then fetched. No task ranks or sorts anything. A pass
    divides a cell's width by ``digits``, so doubles are settled after five. The driver sees
    ``digits`` counts and ``few`` values for each of the two ranks of a share at most.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    whole = values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if not whole["n"]:
        return spark.createDataFrame([], "share double, value double")
    positions = {share: (whole["n"] - 1) * share for share in shares}
    ranks = sorted({rank for p in positions.values() for rank in (math.floor(p), math.ceil(p))})
    waiting, settled = [_Range(whole["low"], whole["high"], 0, whole["n"])], []
    while waiting:
        settled += [r for r in waiting if r.settled(few)]
        waiting = [r for r in waiting if not r.settled(few)]
        if waiting:
            waiting = _refine(values, waiting, ranks, digits)
    at: dict[int, float] = {}
    for r in settled:
        wanted = [rank for rank in ranks if r.before <= rank < r.before + r.rows]
        if r.low == r.high:
            at.update(dict.fromkeys(wanted, r.low))
            continue
        own = sorted(row["v"] for row in values.where(F.col("v").between(r.low, r.high)).collect())
        at.update({rank: own[rank - r.before] for rank in wanted})
    rows = [(s, at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p))) for s, p in positions.items()]
    return spark.createDataFrame(rows, "share double, value double")
