"""Many K-Means fits at once, and silhouettes of many clusterings at once.

All fits (every number of clusters, every restart) take their steps together: one Spark job reads
the vectors once, finds the nearest centre of each fit that still moves, and adds rows and
components up per fit and centre. What reaches the driver is a row per fit and centre. Coordinates
are whole numbers of 1 / ``UNITS``, so sums, centres and with them the clusters do not depend on
the order or the partitioning of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = 1 << 20
MAX_STEPS = 300
TOLERANCE = 1e-4
COST_DIGITS = 9  # costs are sums of doubles; fits that differ less are equally good


@dataclass(frozen=True)
class Fit:
    k: int
    seed: int
    centres: np.ndarray  # coordinates as doubles
    cost: float
    steps: int


def in_units(vector: Column | str) -> Column:
    return F.transform(vector, lambda x: F.round(x * UNITS).cast("long"))


def nearest(vector: Column, centres: np.ndarray) -> Column:
    """The number of the nearest centre, the smallest of equally near ones."""
    apart = distances(vector, centres)
    return (F.array_position(apart, F.array_min(apart)) - 1).cast("int")


def distances(vector: Column, centres: np.ndarray) -> Column:
    """Squared distances to all centres."""
    places = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in centres])
    return F.transform(
        places, lambda centre: F.aggregate(F.zip_with(vector, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x)
    )


# ---- in a task ------------------------------------------------------------------------------


def _points(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("units").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _exact(x: np.ndarray, terms: int) -> bool:
    """Whether doubles hold every sum of ``terms`` products of the coordinates exactly."""
    return len(x) > 0 and 4.0 * terms * float(np.abs(x).max()) ** 2 < 2.0**53


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to all centres. Where all products are exact in doubles, they come from a
    matrix product, which gives the same numbers as the differences."""
    if _exact(x, x.shape[1]) and _exact(centres, x.shape[1]):
        a, b = x.astype(float), centres.astype(float)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    return np.stack([((x - c).astype(float) ** 2).sum(axis=1) for c in centres], axis=1)


def _added(x: np.ndarray, own: np.ndarray, count: int) -> np.ndarray:
    """The rows of each centre added up, as whole numbers."""
    if float(np.abs(x).max()) * len(x) < 2.0**53:
        return np.stack([np.bincount(own, column, count) for column in x.T.astype(float)], axis=1).astype(np.int64)
    total = np.zeros((count, x.shape[1]), np.int64)
    np.add.at(total, own, x)
    return total


def _chance(place: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number between 0 and 1 for each row, from its hash: the same wherever the row is."""
    golden = 0x9E3779B97F4A7C15
    x = place.view(np.uint64) ^ np.uint64((seed * 1000 + step + 1) * golden % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54


def _candidates(centres: dict[int, np.ndarray], seeds: dict[int, int], step: int):
    """Every task's best row to be the next centre of each fit: the smallest of ``-log(u) / w`` is a
    draw by the weight ``w``, the squared distance to the nearest centre so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, place = _points(batch), batch.column("place").to_numpy()
            for fit, found in centres.items():
                weight = _squared(x, found).min(axis=1) if len(found) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    key = np.where(weight > 0, -np.log(_chance(place, seeds[fit], step)) / weight, np.inf)
                at = np.lexsort((place, key))[0]
                mine = (float(key[at]), int(place[at]), x[at].tolist())
                if mine[0] < np.inf and (fit not in best or mine < best[fit]):
                    best[fit] = mine
        rows = [(fit, *row) for fit, row in best.items()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = [pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["fit", "key", "place", "units"])

    return run


def _sums(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {fit: (np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros(c.shape, np.int64)) for fit, c in centres.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch)
            for fit, found in centres.items():
                apart = _squared(x, found)
                own = apart.argmin(axis=1)
                n, cost, total = totals[fit]
                n += np.bincount(own, minlength=len(found))
                cost += np.bincount(own, apart[np.arange(len(x)), own], len(found))
                total += _added(x, own, len(found))
        rows = [
            (fit, c, int(n[c]), float(cost[c]), total[c].tolist()) for fit, (n, cost, total) in totals.items() for c in range(len(n)) if n[c]
        ]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int64())]
        names = ["fit", "centre", "n", "cost", "total"]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return run


# ---- fits -----------------------------------------------------------------------------------


def fit_many(vectors: DataFrame, wanted: list[tuple[int, int]], max_steps: int = MAX_STEPS) -> list[Fit]:
    """A fit for each ``(k, seed)``. ``vectors`` has ``place``, a hash of the row's key, and
    ``units``; it is read once per seeding and Lloyd step of all fits. With fewer than ``k``
    different vectors a fit has fewer centres; without any it is left out."""
    rows = vectors.select("place", "units")
    ks, seeds = {i: k for i, (k, _) in enumerate(wanted)}, {i: seed for i, (_, seed) in enumerate(wanted)}
    centres: dict[int, np.ndarray] = {fit: np.empty((0, 0), np.int64) for fit in ks}
    schema = "fit int, key double, place long, units array<long>"
    for step in range(max(ks.values(), default=0)):
        growing = {fit: found for fit, found in centres.items() if len(found) == step < ks[fit]}
        drawn = rows.mapInArrow(_candidates(growing, seeds, step), schema).groupBy("fit").agg(F.min(F.struct("key", "place", "units")).alias("row"))
        for row in drawn.collect():
            new = np.array([row["row"]["units"]], np.int64)
            centres[row["fit"]] = np.concatenate([centres[row["fit"]], new]) if step else new
    moving = {fit: found for fit, found in centres.items() if len(found)}
    done: dict[int, Fit] = {}
    for step in range(1, max_steps + 1):
        if not moving:
            break
        width = next(iter(moving.values())).shape[1]
        parts = rows.mapInArrow(_sums(moving), "fit int, centre int, n long, cost double, total array<long>").groupBy("fit", "centre")
        moved, cost = {fit: found.copy() for fit, found in moving.items()}, dict.fromkeys(moving, 0.0)
        for row in parts.agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]).collect():
            moved[row["fit"]][row["centre"]] = [(2 * row[f"t{i}"] + row["n"]) // (2 * row["n"]) for i in range(width)]
            cost[row["fit"]] += row["cost"] / UNITS**2
        for fit, before in list(moving.items()):
            if step == max_steps or np.abs(moved[fit] - before).max() <= TOLERANCE * UNITS:
                done[fit] = Fit(ks[fit], seeds[fit], before / UNITS, cost[fit], step)
                del moving[fit]
            else:
                moving[fit] = moved[fit]
    return [done[fit] for fit in sorted(done)]


def best_of(fits: list[Fit]) -> dict[int, Fit]:
    """For each ``k`` the fit of lowest cost, then of lowest seed."""
    best: dict[int, Fit] = {}
    for fit in sorted(fits, key=lambda f: (f.k, float(f"{f.cost:.{COST_DIGITS}g}"), f.seed)):
        best.setdefault(fit.k, fit)
    return best


# ---- silhouettes ----------------------------------------------------------------------------


def silhouettes(vectors: DataFrame, clusterings: dict[int, Column], vector: str = "scaled") -> DataFrame:
    """``(k, silhouette)``: the mean silhouette, by squared distance, of each named clustering of
    the rows. The mean squared distance of a point ``x`` to a cluster of ``n`` points ``y`` is
    ``|x|^2 + (sum |y|^2 - 2 x . sum y) / n``, so sums per cluster are enough: two passes for all
    clusterings, and no pair of rows. A point alone in its cluster counts 0."""
    norm = F.aggregate(F.transform(vector, lambda a: a * a), F.lit(0.0), lambda t, a: t + a)
    rows = vectors.select(
        F.col(vector).alias("x"), norm.alias("norm"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), c.cast("int").alias("c")) for k, c in clusterings.items()])).alias("in"),
    ).select("x", "norm", "in.k", "in.c")
    width = F.size("x")
    totals = (
        rows.select("k", "c", "norm", F.posexplode("x").alias("i", "a")).groupBy("k", "c", "i")
        .agg(F.sum("a").alias("a"), F.sum("norm").alias("norm"), F.count(F.lit(1)).alias("n"))
        .groupBy("k", "c").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("i", "a"))), lambda s: s["a"]).alias("total"),
            F.first("norm").alias("norm"), F.first("n").alias("n"),
        )
    )
    clusters = totals.groupBy("k").agg(F.collect_list(F.struct("c", "total", "norm", "n")).alias("clusters"))

    def apart(cluster: Column) -> Column:
        dot = F.aggregate(F.zip_with("x", cluster["total"], lambda a, b: a * b), F.lit(0.0), lambda t, a: t + a)
        return F.col("norm") + (cluster["norm"] - 2 * dot) / cluster["n"]

    own = F.get(F.filter("clusters", lambda s: s["c"] == F.col("c")), F.lit(0))
    others = F.transform(F.filter("clusters", lambda s: s["c"] != F.col("c")), apart)
    judged = rows.join(clusters, "k").where(width > 0).select(
        "k", own["n"].alias("n"), (apart(own) * own["n"] / F.greatest(own["n"] - 1, F.lit(1))).alias("a"), F.array_min(others).alias("b")
    )
    value = F.when((F.col("n") == 1) | F.col("b").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return judged.groupBy("k").agg(F.avg(value).alias("silhouette"))
