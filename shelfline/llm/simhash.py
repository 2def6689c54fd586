"""Near-duplicates by SimHash fingerprints, found exactly with vantage-point trees.

Fingerprints link when at most ``radius`` bits differ. A vantage-point tree keeps points by their
Hamming distance to a vantage point ``v``: if ``x`` and ``y`` are within ``radius``, the triangle
inequality gives ``|d(x,v) - d(y,v)| <= radius``, so all other branches are skipped. Distances of
unrelated 64-bit fingerprints to any point are all near 32, so a tree over all of them prunes
almost nothing near its root (57 % of all pairs pass each vantage point). The top of the tree
therefore measures distance on blocks of bits: with ``radius + 1`` blocks, two linked fingerprints
differ by 0 bits in at least one, and a branch at radius 0 has no boundary to overlap. Below, the
trees use all 64 bits.

1. distinct fingerprints, each with its smallest document id;
2. one row per fingerprint and block; a shard holds the fingerprints equal on a block;
3. a shard above ``shard_rows`` is cut again in Spark into bands of distance to its vantage point
   (and salted within a band); only bands that the triangle bound lets overlap meet in a task;
4. a task builds the tree of its piece and queries it, and returns a spanning forest of its links,
   never all pairs;
5. components by rounds of star contraction on the links, each round stored.

Nulls: a null text is empty. An empty text has fingerprint zero and links like any other. A null
document id keeps its row; its fingerprint takes the component of the equal ones, or null if no
row with that fingerprint has an id. Repeated rows give repeated rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import map_rows, shingle_hashes
from shelfline.sources.shared import discard, store

BITS = 64
LEAF = 48
SHARD_ROWS = 20_000


def simhash(text: str | None, width: int = 4) -> int:
    """Bit is one where more than half of the shingle hashes have a one."""
    ones, count = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes((text or "").encode().lower().split(), width):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        count += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long."""

    def row(key, text):
        value = simhash(text, width)
        return key, value - (1 << BITS) if value >> (BITS - 1) else value

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], "doc_id long, fp long", row)


# ---- the tree -------------------------------------------------------------------------------


def build_tree(points: np.ndarray, rows: np.ndarray) -> tuple:
    """A leaf is ``(rows,)``; a node is ``(vantage, largest distance inside, inside, outside)``."""
    if len(rows) <= LEAF:
        return (rows,)
    vantage = points[rows[len(rows) // 2]]
    distance = np.bitwise_count(points[rows] ^ vantage)
    edge = int(np.median(distance))
    near = distance <= edge
    if near.all():  # more than half at the largest distance: cut below it, or give up
        near = distance < edge
        edge -= 1
        if not near.any():
            return (rows,)
    return vantage, edge, build_tree(points, rows[near]), build_tree(points, rows[~near])


def query_tree(
    node: tuple, points: np.ndarray, queries: np.ndarray, asked: np.ndarray, radius: int, labels: np.ndarray | None = None
) -> Iterator[tuple]:
    """``(query rows, point rows)`` of all pairs within ``radius``; a batch of queries goes down
    together and splits at each node. With ``labels``, one per point where the points are the
    queries too, pairs of equal labels are passed over; the labels may change between batches."""
    if not len(asked):
        return
    if len(node) == 1:
        rows = node[0]
        step = max(1, (1 << 20) // max(1, len(rows)))
        for start in range(0, len(asked), step):
            part = asked[start : start + step]
            if labels is not None:
                part = part[(labels[part] != labels[rows[0]]) | (labels[rows] != labels[rows[0]]).any()]
            near = np.bitwise_count(queries[part][:, None] ^ points[rows][None, :]) <= radius
            if labels is not None:
                near &= labels[part][:, None] != labels[rows][None, :]
            q, p = np.nonzero(near)
            yield part[q], rows[p]
        return
    vantage, edge, inside, outside = node
    distance = np.bitwise_count(queries[asked] ^ vantage).astype(np.int16)
    yield from query_tree(inside, points, queries, asked[distance <= edge + radius], radius, labels)
    yield from query_tree(outside, points, queries, asked[distance > edge - radius], radius, labels)


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives all points whose labels are linked by the pairs ``(a, b)`` the smallest of these
    labels, in place."""
    first, second = labels[a], labels[b]
    parent = np.arange(len(labels))
    while True:
        x, y = parent[first], parent[second]
        apart = x != y
        if not apart.any():
            break
        first, second, lowest = first[apart], second[apart], np.minimum(x, y)[apart]
        np.minimum.at(parent, x[apart], lowest)
        np.minimum.at(parent, y[apart], lowest)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    labels[:] = parent[labels]


def spanning_links(points: np.ndarray, ids: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """Links ``(id, smallest id of its piece)`` that connect what is linked within a task.
    ``home`` marks the points in the tree; all points are queries. Pairs within a component that is
    known already are not listed, so a large cluster costs comparisons of bits and little else."""
    order = np.argsort(ids, kind="stable")
    points, ids, home = points[order], ids[order], home[order]
    labels = np.arange(len(points))
    tree = build_tree(points, np.flatnonzero(home))
    for asked, found in query_tree(tree, points, points, np.arange(len(points)), radius, labels):
        if len(asked):
            merge_labels(labels, asked, found)
    moved = ids[labels] != ids
    return np.stack([ids[moved], ids[labels][moved]], axis=1)


def _links_of_pieces(radius: int):
    """Streams rows sorted by piece; only one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_key = None
        found: list[np.ndarray] = []

        def close() -> None:
            if held:
                points, ids, home = (np.concatenate(part) for part in zip(*held, strict=True))
                if len(points) > 1:
                    found.append(spanning_links(points, ids, home, radius))
                held.clear()

        def out() -> pa.RecordBatch:
            links = np.concatenate(found) if found else np.empty((0, 2), np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            keys = np.stack([columns[k] for k in ("block", "value", "piece_a", "piece_b")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                key = tuple(keys[start].tolist())
                if key != held_key:
                    close()
                    held_key = key
                held.append((columns["fp"][start:stop].view(np.uint64), columns["id"][start:stop], columns["home"][start:stop].astype(bool)))
            yield out()
        close()
        yield out()

    return run


# ---- Spark ----------------------------------------------------------------------------------


def _blocks(count: int, radius: int) -> int:
    """Blocks of which at least ``blocks - radius`` stay equal; more of them as the table grows,
    so that a shard of unrelated fingerprints stays near a thousand rows."""
    blocks = radius + 1
    while blocks < BITS and count / 2 ** (BITS * (blocks - radius) / blocks) > 2000:
        blocks += 1
    return blocks


def _shard_keys(blocks: int, equal: int) -> list[int]:
    """The masks under which linked fingerprints agree: ``equal`` of ``blocks`` blocks of bits."""
    from itertools import combinations

    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, equal)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(points: DataFrame, radius: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(a, b)``: a spanning set of the links between distinct fingerprints ``(fp, id)``."""
    blocks = _blocks(points.count(), radius)
    masks = _shard_keys(blocks, blocks - radius)
    rows = points.select(
        "fp", "id",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value"))
            for i, mask in enumerate(masks)
        ])).alias("shard"),
    ).select("fp", "id", "shard.*")

    # Shards too large for one task: their bands of distance to the vantage point, with sizes.
    large = rows.groupBy("block", "value").agg(F.count("*").alias("n"), F.min("fp").alias("vantage")).where(F.col("n") > shard_rows)
    band = F.floor(F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))) / (radius + 1)).cast("int")
    banded = rows.join(large.select("block", "value", "vantage"), ["block", "value"], "left").withColumn("band", band)
    large_rows = banded.where(F.col("vantage").isNotNull())
    sizes = store(
        large_rows.groupBy("block", "value", "band").agg(F.ceil(F.count("*") / (shard_rows / 2)).cast("int").alias("salts")), "bands"
    )
    whole = banded.where(F.col("vantage").isNull()).select(
        "block", "value", F.lit(0).alias("piece_a"), F.lit(0).alias("piece_b"), "fp", "id", F.lit(True).alias("home")
    )
    # A piece is a band and a salt. Its points are the tree of the pairs (own, other) and queries
    # of the pairs (other, own); pieces meet only where the triangle bound allows a link.
    neighbours = store(
        sizes.alias("x").join(sizes.alias("y"), ["block", "value"]).where("y.band between x.band - 1 and x.band + 1").groupBy(
            "block", "value", F.col("x.band").alias("band")
        ).agg(
            F.first("x.salts").alias("salts"),
            F.flatten(F.collect_list(F.expr("transform(sequence(0, y.salts - 1), s -> y.band * 100000 + s)"))).alias("others"),
        ),
        "neighbours",
    )
    cut = large_rows.join(neighbours, ["block", "value", "band"]).withColumn(
        "own", F.col("band") * 100000 + F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")
    ).select("block", "value", "own", "fp", "id", F.explode("others").alias("other"))
    pieces = cut.select(
        "block", "value", F.least("own", "other").alias("piece_a"), F.greatest("own", "other").alias("piece_b"), "fp", "id",
        (F.col("own") <= F.col("other")).alias("home"),
    )
    keys = ["block", "value", "piece_a", "piece_b"]
    return whole.unionByName(pieces).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links_of_pieces(radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(a, component)`` for every id that is not the smallest of its component.

    Large-star and small-star rounds: every round points ids at the smallest neighbour, until all
    links of a component meet in its smallest id. A round is stored before the next starts.
    """

    def stars(pairs: DataFrame) -> DataFrame:
        lowest = pairs.groupBy("a").agg(F.min("b").alias("m"))
        return pairs.join(lowest, "a")

    current, before = store(edges.where("a != b").distinct(), "links"), None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return current.select("a", F.col("b").alias("component"))
        before = seen
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stars(both).where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        starred = stars(large)
        small = starred.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        done, current = current, store(small.unionByName(starred.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(done)


def near_duplicates(
    docs: DataFrame, radius: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per document."""
    prints = store(fingerprints(docs, width, id_col, text_col), "fingerprints")
    points = store(prints.groupBy("fp").agg(F.min("doc_id").alias("id")).where("id is not null"), "points")
    found = components(links(points, radius, shard_rows))
    classes = points.join(found, points.id == found.a, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, radius: int = 4, width: int = 4, text_col: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of every group of linked fingerprints, with its columns as they were: the row with
    the smallest id, then the smallest hash of the whole row. Rows are judged, not ids: different
    texts under one id both stay, and a row without an id comes after all that have one. Of rows
    that are equal in every column one stays."""
    key = ["__id", "__h1", "__h2"]
    whole = docs.withColumns({
        "__id": F.col("doc_id").cast("long"), "__h1": F.xxhash64(F.lit(1), *docs.columns), "__h2": F.xxhash64(*docs.columns, F.lit(2)),
    })

    def row(number, first, second, text):
        value = simhash(text, width)
        return number, first, second, value - (1 << BITS) if value >> (BITS - 1) else value

    named = whole.select(*key, F.col(text_col).alias("text"))
    prints = store(map_rows(named, [*key, "text"], "id long, h1 long, h2 long, fp long", row), "rows")
    # Copies are reduced to one row per fingerprint before fingerprints meet their groups.
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "h1", "h2")).alias("row")
    points = store(prints.groupBy("fp").agg(best), "points")
    found = components(links(points.select("fp", F.col("fp").alias("id")), radius, shard_rows))
    grouped = points.join(found, points.fp == found.a, "left").select(F.coalesce("component", "fp").alias("group"), "row")
    named = [F.col(f"row.{c}").alias(f"__of_{c}") for c in ("id", "h1", "h2")]
    chosen = store(grouped.groupBy("group").agg(F.min("row").alias("row")).select(*named), "chosen")
    same = F.col("__id").eqNullSafe(F.col("__of_id")) & (F.col("__h1") == F.col("__of_h1")) & (F.col("__h2") == F.col("__of_h2"))
    kept = whole.join(chosen, same, "left_semi")
    counted = prints.groupBy(F.col("id").alias("__of_id"), F.col("h1").alias("__of_h1"), F.col("h2").alias("__of_h2")).agg(F.count("*").alias("n"))
    repeated = store(counted.where("n > 1").drop("n").join(chosen.select("__of_h1", "__of_h2"), ["__of_h1", "__of_h2"], "left_semi"), "repeated")
    if not repeated.isEmpty():
        again = kept.join(repeated, same, "left_semi").dropDuplicates(key)
        kept = kept.join(repeated, same, "left_anti").unionByName(again)
    return kept.select(*docs.columns)
