"""Replenishment analytics on Spark: table-to-table operators over an inventory star schema."""

from shelfline.star import Star

__all__ = ["Star"]
