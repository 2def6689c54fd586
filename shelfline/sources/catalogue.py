"""Cleaning of a raw product catalogue: all columns arrive as text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import labels

# Column names of the raw file.
SKU, TITLE, BRAND, CATEGORY, SUB_CATEGORY, PRICE = (
    "SKU", "Product Title", "Brand", "Primary Category", "Sub Category 1", "Price",
)


def clean_catalogue(raw: DataFrame, order: Column | str) -> DataFrame:
    """One row per SKU, the first in ``order``; mapped category; numeric price.

    Returns ``(SKU, Product Title, Brand, Clean_Category, Sub Category 1, Price_Clean)``. The
    first row is an aggregate, not a window, so copies of a SKU are dropped before the shuffle.
    """
    kept = F.struct(TITLE, BRAND, CATEGORY, SUB_CATEGORY, PRICE)
    position = F.col(order) if isinstance(order, str) else order
    first = (
        raw.where(F.col(SKU).isNotNull())
        .groupBy(SKU)
        .agg(F.min_by(kept, position).alias("row"))
        .select(SKU, "row.*")
    )
    mapping = F.create_map(*[F.lit(v) for v in chain.from_iterable(labels.CATEGORY_MAP.items())])
    price = F.coalesce(F.col(PRICE).try_cast("double"), F.lit(labels.DEFAULT_PRICE).cast("double"))
    return first.select(
        SKU,
        TITLE,
        BRAND,
        F.coalesce(F.try_element_at(mapping, F.col(CATEGORY)), F.lit(labels.DEFAULT_CATEGORY)).alias("Clean_Category"),
        SUB_CATEGORY,
        F.when(F.isnan(price), F.lit(labels.DEFAULT_PRICE).cast("double")).otherwise(price).alias("Price_Clean"),
    )


def catalogue_products(clean: DataFrame) -> DataFrame:
    """Product columns with the catalogue defaults for what is missing."""
    title = F.substring(TITLE, 1, labels.TITLE_LENGTH)
    return clean.select(
        F.col(SKU).cast("string").alias("sku_id"),
        F.coalesce(title, F.lit(labels.DEFAULT_TITLE)).alias("product_name"),
        F.coalesce(BRAND, F.lit(labels.DEFAULT_BRAND)).alias("brand"),
        F.col("Clean_Category").alias("category"),
        F.coalesce(SUB_CATEGORY, F.lit(labels.DEFAULT_SUB_CATEGORY)).alias("sub_category"),
        F.col("Price_Clean").alias("unit_price"),
    )
