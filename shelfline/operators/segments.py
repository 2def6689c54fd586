"""SKU segmentation: features, K-Means with A-D labels, choice of k, revenue quartiles."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import labels
from shelfline.functions.kmeans import Fit, best_of, distances, fit_many, in_units, nearest, silhouettes
from shelfline.functions.numeric import even_quotient, mean, sample_deviation
from shelfline.functions.quantiles import exact_quantiles
from shelfline.plans.facts import inventory_by_sku, sales_by_sku
from shelfline.sources.shared import store
from shelfline.star import Star

SEED = 42
RESTARTS = 10
# Doubles are averaged as decimals of this scale, so an average does not depend on the order of rows.
AVERAGED_SCALE = 10
OUTPUT = [
    "sku_id", "category", "unit_price", "avg_daily_demand", "demand_cv", "total_revenue", "stockout_rate",
    "inventory_turns", "cluster", "cluster_label",
]


def sku_features(star: Star) -> DataFrame:
    """Demand, variability, revenue, stock rates and turns per product; missing measures are 0.

    Turns divide all units by the mean stock, each sale and stock day counted once.
    """
    demand = mean("units_sum", "units_n")
    stock = mean("on_hand_sum", "on_hand_n")
    deviation = sample_deviation("units_sum", "units_squares", "units_n")
    return (
        star.products.select("sku_id", "category", "unit_price")
        .join(sales_by_sku(star.sales), "sku_id", "left")
        .join(inventory_by_sku(star.stock), "sku_id", "left")
        .select(
            "sku_id", "category", "unit_price",
            demand.alias("avg_daily_demand"),
            deviation.alias("demand_std"),
            F.col("units_sum").alias("total_units"),
            F.col("revenue_sum").cast("double").alias("total_revenue"),
            F.try_divide(deviation, demand).alias("demand_cv"),
            stock.alias("avg_inventory"),
            mean("stockout_days", "stock_rows").alias("stockout_rate"),
            mean("overstock_days", "stock_rows").alias("overstock_rate"),
            F.try_divide(F.col("units_sum").cast("double"), stock).alias("inventory_turns"),
        )
        .na.fill(0)
    )


def scale_features(features: DataFrame, columns: list[str] = labels.CLUSTER_FEATURES) -> DataFrame:
    """Adds ``z_<column>``: mean 0 and population deviation 1; a constant column is only centred."""
    stats = features.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
                for c in columns
            ]
        )
    ).scalar()
    with_stats = features.withColumn("_stats", stats)

    def z(c: str) -> Column:
        spread = F.col(f"_stats.{c}.std")
        return (F.col(c) - F.col(f"_stats.{c}.mean")) / F.when(spread == 0, 1.0).otherwise(spread)

    return with_stats.withColumns({f"z_{c}": z(c) for c in columns}).drop("_stats")


def feature_vectors(features: DataFrame) -> DataFrame:
    """Scaled features as an array column, and what the fits read of them, computed once and stored
    in the shared folder: the fits below each start from it instead of from the fact tables."""
    scaled = scale_features(features)
    vector = F.array(*[F.col(f"z_{c}") for c in labels.CLUSTER_FEATURES])
    named = scaled.withColumn("scaled", vector).drop(*[f"z_{c}" for c in labels.CLUSTER_FEATURES])
    return store(named.withColumns({"place": F.xxhash64("sku_id"), "units": in_units("scaled")}), "vectors")


def best_fits(vectors: DataFrame, ks: list[int], restarts: int = RESTARTS, seed: int = SEED) -> dict[int, Fit]:
    """For each ``k`` the fit with the lowest cost over ``restarts`` seeds; all are made together."""
    return best_of(fit_many(vectors, [(k, seed + number) for k in ks for number in range(restarts)]))


def mean_revenue() -> Column:
    """Mean revenue from an exact sum, in cents and four digits more."""
    return F.avg(F.col("total_revenue").cast("decimal(22,2)"))


def label_clusters(clustered: DataFrame) -> DataFrame:
    """Names clusters A, B, C, D by falling mean revenue (then cluster number), D beyond the fourth."""
    ranked = (
        clustered.groupBy("cluster")
        .agg(mean_revenue().alias("revenue"))
        # One entry per cluster, so the array has k elements.
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("revenue")).alias("r"), F.col("cluster").alias("c")))))
        .scalar()
    )
    order = F.transform(F.col("_ranked"), lambda x: x["c"])
    names = F.array(*[F.lit(name) for name in labels.SEGMENTS])
    rank = F.array_position(order, F.col("cluster")).cast("int")
    return (
        clustered.withColumn("_ranked", ranked)
        .withColumn("cluster_label", F.element_at(names, F.least(rank, F.lit(len(labels.SEGMENTS)))))
        .drop("_ranked")
    )


@dataclass(frozen=True)
class Segmentation:
    assigned: DataFrame  # with the scaled vectors
    fit: Fit

    @property
    def clusters(self) -> DataFrame:
        return self.assigned.select(*OUTPUT)

    @property
    def silhouette(self) -> float:
        """Computed when asked for: it reads all SKUs again."""
        k = self.fit.k
        return silhouettes(self.assigned, {k: F.col("cluster")}).first()["silhouette"]

    def faults(self) -> DataFrame:
        """One row: SKUs, SKUs that are not at their nearest centre, and labels that do not follow
        falling mean revenue. The last two are 0 for any correct fit."""
        apart = distances(F.col("scaled"), self.fit.centres)
        own = F.get(apart, F.col("cluster"))
        judged = self.assigned.select("cluster_label", "total_revenue", (own > F.array_min(apart) + 1e-9).alias("far"))
        per_label = judged.groupBy("cluster_label").agg(
            F.count(F.lit(1)).alias("skus"), F.count_if("far").alias("far"), mean_revenue().alias("revenue")
        )
        # One entry per label, so the array has four elements at most.
        revenues = F.transform(F.sort_array(F.collect_list(F.struct("cluster_label", "revenue"))), lambda x: x["revenue"])
        rising = F.filter(
            F.zip_with(revenues, F.slice(revenues, 2, F.size(revenues)), lambda a, b: b > a), lambda x: F.coalesce(x, F.lit(False))
        )
        return per_label.agg(
            F.sum("skus").alias("skus"), F.sum("far").alias("not_at_nearest"), F.size(rising).cast("long").alias("labels_out_of_order")
        )


def segment_skus(star: Star, k: int = 4, restarts: int = RESTARTS) -> Segmentation:
    vectors = feature_vectors(sku_features(star))
    fit = best_fits(vectors, [k], restarts).get(k) or Fit(k, SEED, np.zeros((1, len(labels.CLUSTER_FEATURES))), 0.0, 0)
    return Segmentation(label_clusters(vectors.withColumn("cluster", nearest(F.col("scaled"), fit.centres))), fit)


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Averages per label, to 2 digits: sums of decimals, divided once and rounded half to even."""

    def average(column: str, scale: int = AVERAGED_SCALE) -> Column:
        value = F.col(column).cast(f"decimal(28,{scale})")
        return even_quotient(F.sum(value), F.count(value), 2, scale).cast("double")

    return (
        clusters.groupBy("cluster_label")
        .agg(
            F.count("sku_id").alias("sku_count"),
            average("avg_daily_demand").alias("avg_demand"),
            average("demand_cv").alias("avg_variability"),
            F.sum(F.col("total_revenue").cast("decimal(22,2)")).alias("total_revenue"),
            average("total_revenue", 2).alias("avg_revenue"),
            average("stockout_rate").alias("avg_stockout_rate"),
            average("inventory_turns").alias("avg_turns"),
        )
        .orderBy("cluster_label")
    )


def describe_segments(clusters: DataFrame) -> DataFrame:
    """SKUs per label with what the label means."""
    meaning = F.create_map(*[F.lit(v) for pair in labels.SEGMENTS.items() for v in pair])
    return clusters.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("sku_count")).withColumn(
        "description", F.coalesce(F.try_element_at(meaning, F.col("cluster_label")), F.lit("N/A"))
    )


def choose_k(star: Star, max_k: int = 8, restarts: int = RESTARTS) -> DataFrame:
    """``(k, silhouette)`` for 2 to ``max_k`` clusters: all fits take their steps together, and one
    pair of passes gives all silhouettes."""
    vectors = feature_vectors(sku_features(star))
    fits = best_fits(vectors, [*range(2, max_k + 1)], restarts)
    return silhouettes(vectors, {k: nearest(F.col("scaled"), fit.centres) for k, fit in fits.items()})


def silhouettes_of_dealt(star: Star, max_k: int = 8) -> DataFrame:
    """``(k, silhouette)`` of SKUs dealt out by their number, which any engine can repeat."""
    vectors = feature_vectors(sku_features(star))
    found = silhouettes(vectors, {k: F.col("sku_id").cast("long") % k for k in range(2, max_k + 1)})
    return found.select("k", F.round("silhouette", 6).alias("silhouette"))


def revenue_quartiles(star: Star) -> DataFrame:
    """SKUs with sales, labelled D to A by quartile of revenue; a cut point belongs to the lower bin.
    Sales are added up once: the splits, the counts and the labels read the stored sums."""
    per_sku = store(
        sales_by_sku(star.sales).select(
            "sku_id", mean("units_sum", "units_n").alias("avg_daily_demand"), F.col("revenue_sum").alias("total_revenue")
        ),
        "revenue",
    )
    cuts = exact_quantiles(per_sku, "total_revenue", [0.25, 0.5, 0.75])
    edges = cuts.agg(F.sort_array(F.collect_list("value"))).scalar()
    above = F.size(F.filter(F.col("_edges"), lambda e: e < F.col("total_revenue").cast("double")))
    names = F.array(*[F.lit(name) for name in reversed(labels.SEGMENTS)])
    return (
        per_sku.withColumn("_edges", edges)
        .withColumn("cluster_label", F.element_at(names, above + 1))
        .drop("_edges")
    )
