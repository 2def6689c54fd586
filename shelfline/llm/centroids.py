"""Centroid clustering (Lloyd's iterations) with ns-bounds.

Every vector keeps, for each centroid, the distance that was last evaluated and the round in which
that was. The centroids of all rounds are kept too: ``k`` vectors a round, on the driver and in
the function sent to the tasks. In a later round a stored distance is loosened by the norm of the
total displacement of its centroid since the round of evaluation (ns-bounds: norm of the sum of
moves, never more than the sum of the norms). If no loosened lower bound reaches the upper bound of
the vector's own centroid, the vector stays without any distance being taken. Otherwise the
distance to its own centroid is evaluated, and then those to exactly the centroids whose lower
bound still fails; ties go to the smaller number. Bounds are stored as 32-bit floats and compared
with a margin above their rounding, and every decision is taken on exact whole-number distances, so
the result is that of plain iterations.

A vector never leaves its partition. A round writes one table, of vectors and bounds, to the shared
X
the driver. The table of the round before is removed.

Vectors count only if they have exactly ``dims`` components, none null or not finite; others, and
null vectors, are left out. Null and repeated ids keep their rows; a null id stands for an empty
one in the hash that picks the first centroids, and equal hashes are ordered by the vectors. With
fewer than ``k`` vectors there are as many centroids. Components must stay below 2**27 after
scaling, else a long could not hold a distance and the query stops with an error. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.sources.shared import discard, store

DIMS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
LARGEST = 1 << 27
# Above the relative rounding of 32-bit floats, square roots and sums of displacements.
MARGIN = 1e-6

STATE = "vec_id long, v array<int>, cluster int, bounds array<float>, seen array<tinyint>, evaluated int"
ASSIGNED = "vec_id long, cluster int, distance long, evaluated int"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, evaluated int"


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the vectors that count, as whole numbers ``floor(scale * x)``."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))

    def whole(e):
        scaled = F.floor(e * F.lit(float(scale)))
        too_large = F.raise_error(F.lit(f"a vector has a component of {LARGEST // scale} or more")).cast("int")
        return F.when(F.abs(e) < LARGEST / scale, scaled.cast("int")).otherwise(too_large)

    counted = vectors.where((F.size(x) == dims) & usable)
    return counted.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select("v", place.alias("place")).orderBy("place", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


# ---- one batch in a task --------------------------------------------------------------------


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def assign_first(x: np.ndarray, centroids: np.ndarray) -> tuple:
    distances = squared(x, centroids)
    return distances.argmin(axis=1), np.sqrt(distances).astype(np.float32), np.zeros(distances.shape, np.int8), np.full(len(x), len(centroids))


def assign_again(x: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, seen: np.ndarray, history: np.ndarray) -> tuple:
    """``(cluster, bounds, seen, evaluated)`` after the last centroids of ``history`` (rounds, k,
    dims) were tried; ``bounds`` and ``seen`` are changed in place."""
    now, centroids = len(history) - 1, history[-1]
    moved = np.sqrt(((history[:-1] - centroids) ** 2).sum(axis=2).astype(float))  # (rounds before, k)
    rows, k = np.arange(len(x)), len(centroids)
    shift = moved[seen, np.arange(k)] * (1 + MARGIN)
    lower = bounds.astype(float) * (1 - MARGIN) - shift
    upper = bounds[rows, cluster].astype(float) * (1 + MARGIN) + shift[rows, cluster]
    lower[rows, cluster] = np.inf
    failed = np.flatnonzero(lower.min(axis=1) <= upper) if k > 1 else rows[:0]
    evaluated = np.zeros(len(x), np.int64)
    cluster = cluster.copy()
    if len(failed):
        own = ((x[failed] - centroids[cluster[failed]]) ** 2).sum(axis=1)
        bounds[failed, cluster[failed]], seen[failed, cluster[failed]] = np.sqrt(own), now
        row, other = np.nonzero(lower[failed] <= np.sqrt(own)[:, None] * (1 + MARGIN))
        tried = ((x[failed[row]] - centroids[other]) ** 2).sum(axis=1)
        bounds[failed[row], other], seen[failed[row], other] = np.sqrt(tried), now
        # The smallest distance, then the smallest number, of the own centroid and those tried.
        who = np.concatenate([np.arange(len(failed)), row])
        which = np.concatenate([cluster[failed], other])
        order = np.lexsort((which, np.concatenate([own, tried]), who))
        first = np.flatnonzero(np.diff(who[order], prepend=-1))
        cluster[failed] = which[order][first]
        evaluated[failed] = 1 + np.bincount(row, minlength=len(failed))
    return cluster, bounds, seen, evaluated


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), kind))


def _round(history: np.ndarray):
    """The task of a round: new clusters and bounds of every batch."""
    _, k, dims = history.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), dims, np.int64)
            if len(history) == 1:
                cluster, bounds, seen, evaluated = assign_first(x, history[0])
            else:
                before = batch.column("cluster").to_numpy().astype(np.int64)
                old = _matrix(batch.column("bounds"), k, np.float32), _matrix(batch.column("seen"), k, np.int8)
                cluster, bounds, seen, evaluated = assign_again(x, before, *old, history)
                evaluated = evaluated + batch.column("evaluated").to_numpy()
            columns = [
                batch.column("vec_id"), batch.column("v"), pa.array(cluster, pa.int32()), _lists(bounds, pa.float32()), _lists(seen, pa.int8()),
                pa.array(evaluated, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "cluster", "bounds", "seen", "evaluated"])

    return run


def _distances(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), centroids.shape[1], np.int64)
            distance = ((x - centroids[batch.column("cluster").to_numpy()]) ** 2).sum(axis=1)
            columns = [batch.column("vec_id"), batch.column("cluster"), pa.array(distance, pa.int64()), batch.column("evaluated")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "evaluated"])

    return run


def _task_sums(k: int, dims: int):
    """Row counts and sums of a task's vectors, one row per cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            own = batch.column("cluster").to_numpy()
            counts += np.bincount(own, minlength=k)
            np.add.at(totals, own, _matrix(batch.column("v"), dims, np.int64))
        used = np.flatnonzero(counts)
        if len(used):
            columns = [pa.array(used, pa.int32()), pa.array(counts[used]), _lists(totals[used], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    return run


# ---- Spark ----------------------------------------------------------------------------------


def move_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of every cluster's mean, component by component; empty clusters stay."""
    sums = state.select("cluster", "v").mapInArrow(_task_sums(*centroids.shape), "cluster int, n long, total array<long>")
    parts = sums.select("cluster", "n", F.posexplode("total").alias("i", "total")).groupBy("cluster", "i")
    moved = centroids.copy()
    for row in parts.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k * dims rows
        moved[row.cluster, row.i] = row.total // row.n
    return moved


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance, evaluated)`` of whole vectors ``(vec_id, v)``, stored, and the
    centroids. ``evaluated`` is the number of distances that were taken for a vector in all
    rounds; without bounds it would be ``k * (rounds + 1)``."""
    history = first_centroids(vectors, k, seed)[None]
    if not history.size:
        return vectors.sparkSession.createDataFrame([], ASSIGNED), history[0]
    state = store(vectors.mapInArrow(_round(history), STATE), "vectors")
    for _ in range(rounds):
        history = np.concatenate([history, move_centroids(state, history[-1])[None]])
        before, state = state, store(state.mapInArrow(_round(history), STATE), "vectors")
        discard(before)
    found = store(state.mapInArrow(_distances(history[-1]), ASSIGNED), "assigned")
    discard(state)
    return found, history[-1]


def cluster_embeddings(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``RESULT``: one row per vector that counts, with its cluster's sum of squared distances,
    that of all clusters, and a digest of its centroid."""
    spark = embeddings.sparkSession
    vectors = store(whole_vectors(embeddings, dims, scale), "whole")
    found, centroids = cluster(vectors, k, rounds, seed)
    discard(vectors)
    inertia = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    total = sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(c, t, total, digests[c]) for c, t in inertia.items()]
    # One row per centroid: at most k.
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(*[part.split()[0] for part in RESULT.split(", ")])


def cluster_sql(k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> str:
    """The same clusters in DuckDB's SQL, with every distance in every round."""
    steps = [
        f"x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {scale}) AS BIGINT)) AS v "
        f"FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS k, v AS c FROM x "
        f"QUALIFY k < {k})",
    ]
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for t in range(rounds + 1):
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT r, k, CAST({distance} AS BIGINT) AS d FROM x, c{t}) GROUP BY r)")
        if t < rounds:
            steps += [
                f"s{t} AS MATERIALIZED (SELECT k, i, sum(e) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS e, unnest(range({dims})) AS i FROM x JOIN a{t} USING (r)) GROUP BY k, i)",
                f"m{t} AS MATERIALIZED (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{t} GROUP BY k)",
                f"c{t + 1} AS MATERIALIZED (SELECT k, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (k))",
            ]
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, "
        "CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, "
        f"sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN x USING (r) JOIN c{rounds} USING (k)"
    )
