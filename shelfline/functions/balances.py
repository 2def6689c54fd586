"""Stock balances of many SKUs at once: the numpy step of the ledger, run inside tasks.

A row holds all movements of one SKU's listing, bounded by its calendar. ``level_pieces`` gives the
days in a row on which its stock is alike, as parallel arrays; Spark makes rows of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

PIECES = {"day": "int", "units": "int", "on_hand_qty": "int", "stockout_flag": "boolean"}
ROWS_AT_ONCE = 200
MEASURE = 10  # digits of the ledger's decimal measures
EPOCH = dt.date(1970, 1, 1)


def day_number(day: dt.date) -> int:
    return (day - EPOCH).days


def month_starts(first: dt.date | None, last: dt.date | None) -> list[int]:
    """The first day and every first of a month up to the last day, as numbers of days."""
    if first is None or last is None:
        return []
    months = range(first.year * 12 + first.month, last.year * 12 + last.month)
    return [day_number(day) for day in (first, *[dt.date(m // 12, m % 12 + 1, 1) for m in months])]


def level_pieces(bounds: tuple[dt.date | None, dt.date | None]) -> Callable:
    """A column function of ``(start, reorder_point, again, sold, received)``: the opening level, the
    level at which orders are triggered, whether the row is a further listing of its SKU, and lists of
    its daily sales (``day, units``) and receipts (``dates, units``). Movements without a day come before all others.

    Of every piece, in order and without gaps: its first ``day``, ``units`` sold a day the level ``on_hand_qty``
    after each of its days and whether that is 0; levels count from 0 where ``start`` is NULL. Days are cut at movements and month
    starts, and after a movement where the units, or the level before that decides on orders, are others on
    the days that follow. Further listings of a SKU find their own day's level before them.
    """
    starts = np.array(month_starts(*bounds), dtype=np.int64)
    first, last = (day_number(day) if len(starts) else 0 for day in bounds)

    def pieces(start: pa.Array, reorder: pa.Array, again: pa.Array, sold: pa.Array, received: pa.Array) -> pa.Array:
        found = [
            _pieces(starts, first, last, *[column.slice(at, ROWS_AT_ONCE) for column in (start, reorder, again, sold, received)])
            for at in range(0, len(start), ROWS_AT_ONCE)
        ]
        ends = np.cumsum(np.concatenate([[0], *[counts for counts, _ in found]]))
        lists = [
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)).cast(pa.bool_() if kind == "boolean" else pa.int32()))
            for kind, values in zip(PIECES.values(), zip(*[values for _, values in found], strict=True), strict=True)
        ]
        return pa.StructArray.from_arrays(lists, list(PIECES))

    # Filters on its result would be pushed below it and make it twice.
    return F.arrow_udf(pieces, f"struct<{', '.join(f'{name}: array<{kind}>' for name, kind in PIECES.items())}>").asNondeterministic()


def _numbers(column: pa.Array, missing: int = 0) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(missing).to_numpy(zero_copy_only=False)


def _lengths(lists: pa.Array) -> np.ndarray:
    return _numbers(pc.list_value_length(lists))


def _days(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of days, and where there is one."""
    return _numbers(column.cast(pa.int32())), column.is_valid().to_numpy(zero_copy_only=False)


def _movements(sold: pa.Array, received: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, day, whether there is a day and an amount, units sold and received of every movement."""
    sales = sold.flatten()
    sale_row = np.repeat(np.arange(len(sold)), _lengths(sold))
    sale_day, sale_dated = _days(sales.field("day"))
    receipts = received.flatten()
    times = _lengths(receipts.field("dates"))
    receipt_row = np.repeat(np.repeat(np.arange(len(received)), _lengths(received)), times)
    receipt_day, receipt_dated = _days(receipts.field("dates").flatten())
    units, arriving = sales.field("units"), receipts.field("units")

    def both(of_sales: np.ndarray, of_receipts: np.ndarray) -> np.ndarray:
        return np.concatenate([of_sales, of_receipts])

    return (
        both(sale_row, receipt_row), both(sale_day, receipt_day), both(sale_dated, receipt_dated),
        both(units.is_valid().to_numpy(zero_copy_only=False), np.repeat(arriving.is_valid().to_numpy(zero_copy_only=False), times)),
        both(_numbers(units), np.zeros(len(receipt_row), np.int64)),
        both(np.zeros(len(sale_row), np.int64), np.repeat(_numbers(arriving), times)),
    )


def _pieces(
    starts: np.ndarray, first: int, last: int, start: pa.Array, reorder: pa.Array, again: pa.Array, sold: pa.Array, received: pa.Array
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of pieces of every row, and the columns of all pieces."""
    rows = len(start)
    if not len(starts):
        return np.zeros(rows, np.int64), [np.zeros(0, np.int64)] * len(PIECES)
    row, day, dated, known, out, into = _movements(sold, received)
    # Amounts that are not known cut the calendar as others do, but before its first day they count for nothing.
    wanted = np.where(dated, day <= last, True) & (known | (dated & (day >= first)))
    row, day, dated, out, into = (column[wanted] for column in (row, day, dated, out, into))
    lowest_day = min(first, int(day[dated].min())) - 1 if dated.any() else first - 1
    row = np.concatenate([np.repeat(np.arange(rows), len(starts)), row])
    day = np.concatenate([np.tile(starts, rows), np.where(dated, day, lowest_day)])
    none = np.zeros(rows * len(starts), np.int64)
    out, into = np.concatenate([none, out]), np.concatenate([none, into])

    # One entry per row and day, in order; every row has an entry on the first day.
    width = last - lowest_day + 1
    key = row * width + (day - lowest_day)
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sold_units = np.add.reduceat(out[order], heads)
    change = np.add.reduceat(into[order], heads) - sold_units
    row, day = np.divmod(key[heads], width)
    day += lowest_day

    # Running balance of a row, and its lowest point so far.
    opens = np.searchsorted(row, np.arange(rows))
    total = np.cumsum(change)
    net = total - (total[opens] - change[opens])[row]
    apart = row * (net.max() - net.min() + 1)
    lowest = np.minimum.accumulate(net - apart) + apart
    opening = _numbers(start)[row]
    on_hand = opening + net - np.minimum(0, opening + lowest)
    seen = np.where(day > first, np.concatenate([[0], on_hand[:-1]]), opening)
    seen = np.where(again.to_numpy(zero_copy_only=False).astype(bool)[row], on_hand, seen)
    until = np.concatenate([np.where(row[1:] == row[:-1], day[1:], last + 1), [last + 1]])
    inside = day >= first
    row, day, units, on_hand, seen, days = (column[inside] for column in (row, day, sold_units, on_hand, seen, until - day))

    # The day of the movement, and the days after it, where they differ.
    level = _numbers(reorder)[row]
    unknown = (start.is_null().to_numpy(zero_copy_only=False) | reorder.is_null().to_numpy(zero_copy_only=False))[row]
    alike = (days == 1) | ((units == 0) & (unknown | ((seen <= level) == (on_hand <= level))))
    times = np.where(alike, 1, 2)
    place = np.repeat(np.arange(len(row)), times)
    rest = np.cumsum(times)[~alike] - 1
    day, units, on_hand = day[place], units[place], on_hand[place]
    day[rest] += 1
    units[rest] = 0
    return np.bincount(row[place], minlength=rows), [day, units, on_hand, on_hand == 0]


def spans_in_columns(series: pa.RecordBatch, fallback: int) -> pa.Table:
    """The spans of series (``ledger.to_columns``) as ``ledger.levels_of`` and ``ledger.with_measures`` make
    them, for writers that take columns: texts by number, decimals as longs of their last digit."""
    lists = series.column("day")
    lengths = _lengths(lists)
    row = np.repeat(np.arange(len(lists)), lengths)
    day, units, levels = (_numbers(series.column(name).flatten()) for name in ("day", "units", "on_hand_qty"))
    some = lengths > 0
    ends = np.cumsum(lengths)
    heads, tails = (ends - lengths)[some], ends[some] - 1
    after, before = np.roll(day, -1), np.roll(levels, 1)
    after[tails], before[heads] = _numbers(series.column("until").cast(pa.int32()))[some], _numbers(series.column("start"))[some]

    def of_row(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = series.column(name)
        return _numbers(column)[row], column.is_valid().to_numpy(zero_copy_only=False)[row]

    (most, known), (reorder, has_reorder), (cents, has_price) = map(of_row, ("max_stock_level", "reorder_point", "cents"))
    seen = np.where(series.column("again").to_numpy(zero_copy_only=False).astype(bool)[row], levels, before)
    empty = series.column("stockout_flag").flatten().to_numpy(zero_copy_only=False).astype(bool)
    supply = _half_even(levels * 10, np.where(units > 0, units, fallback))
    if (np.abs(levels.astype(float) * cents) > 10.0 ** (MEASURE + 4)).any():  # more than the column's digits, before it is more than a long
        raise OverflowError("a cost a day does not fit its column")
    cost = _half_even(levels * cents * 5, np.int64(10_000))

    def column(values: np.ndarray, valid: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.array(values, mask=~valid).cast(kind)

    def decimal(values: np.ndarray, valid: np.ndarray, scale: int) -> pa.Array:
        if (np.abs(values[valid]) >= 10**MEASURE).any():
            raise OverflowError("a measure does not fit its column")
        return pa.array(values, mask=~valid).view(pa.decimal64(MEASURE, scale))

    names, place = series.column("sku_id").dictionary_encode(), pa.array(row)
    flag, number = pa.bool_(), pa.int32()
    return pa.table(
        {
            "date": pa.array(day.astype(np.int32)).cast(pa.date32()),
            "sku_id": pa.DictionaryArray.from_arrays(names.indices.take(place), names.dictionary),
            "on_hand_qty": column(levels, known, number),
            "units_sold": pa.array(units).cast(number),
            "reorder_triggered": column(seen <= reorder, known & has_reorder, flag),
            "stockout_flag": column(empty, known, flag),
            "overstock_flag": column(levels > most, known, flag),
            "days_of_supply": decimal(supply, known, 1),
            "safety_stock": series.column("safety_stock").take(place),
            "reorder_point": series.column("reorder_point").take(place),
            "instock_flag": column(~empty, known, flag),
            "carrying_cost_daily": decimal(cost, known & has_price, 2),
            "days": after - day,
        }
    )


def _half_even(number: np.ndarray, by: np.ndarray) -> np.ndarray:
    """As ``numeric.half_even``, in units of the last digit: cut off towards zero, then up from a half."""
    whole = number // by
    whole += (whole < 0) & (whole * by != number)
    twice = (number - whole * by) * 2
    return whole + ((twice > by) | ((twice == by) & (whole % 2 == 1)))
