"""The five domain tables, plus the optional derived ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Star:
    """One row per SKU in ``products``, per supplier in ``suppliers``; facts are append-only.

    ``clusters``, ``forecasts`` and ``alerts`` are results of earlier jobs and may be absent;
    ``sales_of_sku()`` gives stored sums of ``sales``, one row per SKU with a map from days. ``buckets``
    is the number of hash partitions on SKU that ``inventory`` comes in, if it does. ``spans`` holds the
    rows of ``inventory`` with one row for days in a row that are alike (see ``functions/dates.py``).
    ``levels`` are the columns of ``spans`` that its measures follow from (``ledger.with_measures``), and
    ``series`` what ``levels`` is made of (``ledger.levels_of``), one row per listing of a SKU.
    ``cut_at_sales`` says that every day of a SKU with ``sales`` is the first of a span.
    ``calendar`` is the first and last day of ``sales``, if they are known.
    """

    products: DataFrame
    suppliers: DataFrame
    sales: DataFrame
    inventory: DataFrame
    orders: DataFrame
    clusters: DataFrame | None = None
    forecasts: DataFrame | None = None
    alerts: DataFrame | None = None
    sales_of_sku: Callable[[], DataFrame] | None = None
    buckets: int | None = None
    spans: DataFrame | None = None
    levels: DataFrame | None = None
    series: DataFrame | None = None
    cut_at_sales: bool = False
    calendar: tuple[dt.date | None, dt.date | None] | None = None

    @property
    def stock(self) -> DataFrame:
        """The inventory as spans where the star has them, else by day: a row counts for its days."""
        return self.inventory if self.spans is None else self.spans

    def with_derived(self, **tables) -> "Star":
        if "sales" in tables:
            tables = {"calendar": None, "cut_at_sales": False} | tables
        if "inventory" in tables:
            tables = {"spans": None, "levels": None, "series": None, "cut_at_sales": False, "buckets": None} | tables
        return replace(self, **tables)
