"""A trie of conversation prefixes, measured along its Euler tour.

A node is a distinct sequence of first turns; the root has none. Subtree sums come from a tour that
walks down and up every edge: each node has an enter and an exit arc, and what a subtree holds is
the difference of two prefix sums along the tour.

1. Turns are reduced to a digest of role and text and a word count; texts are not read again. Their
   place in a conversation is a running count.
2. A prefix is named by 128 bits: the exclusive or of one hash per place and turn. So the name of
   every prefix is a running total, and its parent's name is the name without the last turn.
3. Nodes are the groups of equal names. A very common prefix is added up in the tasks first.
4. Arcs follow from the first, last and neighbouring children of each node.
5. The tour is ranked as a linked list in Spark: in every round each arc whose random priority is
   below that of both its neighbours is spliced out (a third of all arcs), its weights going to the
   arc before it; when at most ``TAIL_ARCS`` are left one task walks them, and the rounds are undone
   in reverse. Ranks carry three sums: arcs, leaves and savings before an arc.

Running totals and neighbours are found over rows dealt by range, with one carried row per range, so
a conversation, or a node's children, may be larger than any task. Every round is a table in the
shared folder, and tables that nothing reads any more are removed.

Turns are ordered by turn (null first), then by digest; a null role or text is empty. Rows without a
``conv_id`` belong to no conversation and are left out. Repeated rows are repeated turns. Without
conversations there are no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.text import WORD, empty_text
from shelfline.sources.shared import discard, store

GROUP = 20  # conversations that share their first turns
HEADS = 4  # so many lengths of shared heads: 0 to 3 turns
TAIL_ARCS = 20_000
CHUNK_IDS = 4096

# A kind of total: the aggregate, and how two totals become one. Both start at zero.
Total = tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]
ADD: Total = (F.sum, lambda a, b: a + b)
XOR: Total = (F.bit_xor, lambda a, b: a.bitwiseXOR(b))


# ---- rows dealt by range --------------------------------------------------------------------


def deal(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` stored with ``part``, the range that a row is in: all rows of a lower range come
    before those of a higher one, by ``group`` and then ``order``."""
    return store(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), "dealt")


def running(dealt: DataFrame, group: str, order: str, totals: dict[str, tuple[str, Total]]) -> DataFrame:
    """``dealt`` with running totals ``{name: (column, kind)}`` in each group, the row included.
    Totals run within a range; a group that goes on in the next range gets what it had before
    from a table of at most one row per range."""
    within = Window.partitionBy(group, "part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumns({name: kind[0](F.col(column)).over(within) for name, (column, kind) in totals.items()})
    spread = dealt.groupBy(group, "part").agg(*[kind[0](column).alias(f"__{name}") for name, (column, kind) in totals.items()])
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.select(
        F.col(group).alias("__group"), F.col("part").alias("__part"), F.lag("part").over(Window.partitionBy(group).orderBy("part")).alias("__last"),
        *[kind[0](f"__{name}").over(before).alias(f"__{name}") for name, (_, kind) in totals.items()],
    ).where("__last is not null").drop("__last")
    joined = inside.join(carried, (F.col(group) == F.col("__group")) & (F.col("part") == F.col("__part")), "left")
    return joined.select(
        *dealt.columns, *[kind[1](F.col(name), F.coalesce(f"__{name}", F.lit(0).cast("long"))).alias(name) for name, (_, kind) in totals.items()]
    )


# ---- conversations --------------------------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, digest, words)``: turns in order from place 1, without their texts."""
    role, text = empty_text("role"), empty_text("text")
    narrow = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("words"), F.lit(1).cast("long").alias("one"),
    )
    # Nulls come first in a struct's order too.
    dealt = deal(narrow.withColumn("at", F.struct("turn", "digest")), ["conv_id"], ["at"])
    placed = store(running(dealt, "conv_id", "at", {"place": ("one", ADD)}).select("conv_id", "part", "place", "digest", "words"), "turns")
    discard(dealt)
    return placed


def share_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations rebuilt on shared heads: turns ``(conv_id, part, place, digest, words)``,
    and a stored table with ``conv_id`` and ``turns`` of all conversations, also those left
    without turns."""
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("part"))
    convs = own.select(
        "conv_id", "n", "part", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("head")
    )
    first = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("place") < HEADS))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("first"))
    known = convs.join(heads, "base", "left").withColumn("first", F.slice(F.coalesce("first", F.array().cast(heads.schema["first"].dataType)), 1, F.col("head").cast("int")))
    known = known.withColumn("taken", F.size("first").cast("long"))
    known = store(known.withColumn("turns", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))), "heads")
    shared = known.select("conv_id", "part", F.inline("first"))
    # Own turns move from behind the own head to behind the shared one.
    left = turns.join(known.select("conv_id", "head", "taken"), "conv_id").where("place > head")
    moved = left.select("conv_id", "part", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "digest", "words")
    return shared.select("conv_id", "part", "place", "digest", "words").unionByName(moved), known


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, words, k1, k2, p1, p2)``: the name of every conversation's first
    ``place`` turns, and that of one turn less."""
    hashed = turns.select(
        "conv_id", "part", "place", "words",
        F.xxhash64(F.lit(1), "place", "digest").alias("h1"), F.xxhash64(F.lit(2), "digest", "place", F.lit(3)).alias("h2"),
    )
    named = running(hashed, "conv_id", "place", {"k1": ("h1", XOR), "k2": ("h2", XOR)})
    return named.select(
        "conv_id", "place", "words", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2")
    )


# ---- nodes ----------------------------------------------------------------------------------


def _taken(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """The rows as a batch, the last column text and the others numbers; ``rows`` is emptied."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    rows.clear()
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)


def _digest_ids(ends: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)`` from ``(depth, k1, k2, conv_id)``. Ids are dealt by range
    and joined in order to long strings, so the task that takes a node's digest, which has to see
    all of them in order, reads few rows and holds one."""
    key = ["depth", "k1", "k2"]

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now, ids = None, []

        def close() -> None:
            if ids:
                rows.append((*now, ids[0], ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != now or len(ids) >= CHUNK_IDS:
                    close()
                    now = own
                ids.append(conv)
            yield _taken(rows, [*key, "first", "ids"])
        close()
        yield _taken(rows, [*key, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []
        for batch in batches:
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in [*key, "ids"]), strict=True):
                if own != now:
                    if now:
                        done.append((*now, sha.hexdigest()))
                    now, sha = own, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield _taken(done, [*key, "ends_sha256"])
        if now:
            done.append((*now, sha.hexdigest()))
        yield _taken(done, [*key, "ends_sha256"])

    ranged = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    strings = ranged.mapInArrow(glue, "depth long, k1 long, k2 long, first long, ids string")
    return strings.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


def nodes_of(named: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, stored: ``id``, its name and its parent's, members, own savings, digest of
    the members that end here, parent's id and conversation."""
    key = ["depth", "k1", "k2"]
    zero = F.lit(0).cast("long")
    groups = named.groupBy(F.col("place").alias("depth"), "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(c) for c in key], "conv_id", "n_convs", *[zero.alias(c) for c in ("words", "p1", "p2")]
    )
    ends = named.join(convs, (named["conv_id"] == convs["conv_id"]) & (named["place"] == convs["turns"])).select(
        F.col("place").alias("depth"), "k1", "k2", named["conv_id"]
    ).unionByName(convs.where("turns = 0").select(*[zero.alias(c) for c in key], "conv_id"))
    digests = _digest_ids(ends)
    ended = groups.unionByName(root).join(digests, key, "left")
    found = store(
        ended.select(
            F.monotonically_increasing_id().alias("id"), *key, "p1", "p2", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        ),
        "nodes",
    )
    # The children of the root may be very many: their parent is known without a join.
    top = found.where("depth = 0").select("id", "conv_id").first()
    parents = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    deep = found.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    shallow = found.where("depth < 2").withColumns({
        "parent": F.when(F.col("depth") == 1, F.lit(top and top.id).cast("long")),
        "parent_conv_id": F.when(F.col("depth") == 1, F.lit(top and top.conv_id).cast("long")),
    })
    linked = store(deep.unionByName(shallow).drop("p1", "p2", "k1", "k2"), "linked")
    discard(found)
    return linked


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs ``(arc, before, after, arcs, leaves, saved)`` of the Euler tour: ``2 * id`` enters
    a node, ``2 * id + 1`` leaves it. Children are visited by id."""
    enter, leave = lambda c: c * 2, lambda c: c * 2 + 1
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.min("id").alias("first"), F.max("id").alias("last"))
    dealt = deal(nodes.where("parent is not null").select("id", "parent"), ["parent"], ["id"])
    near = Window.partitionBy("parent", "part").orderBy("id")
    ranges = dealt.groupBy("parent", "part").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    over = Window.partitionBy("parent").orderBy("part")
    # A range's first and last child of a parent have their neighbours in other ranges.
    edges = ranges.select("parent", "part", F.lag("last").over(over).alias("lower"), F.lead("first").over(over).alias("higher")).where("lower is not null or higher is not null")
    siblings = dealt.select("parent", "part", "id", F.lag("id").over(near).alias("left"), F.lead("id").over(near).alias("right")).join(edges, ["parent", "part"], "left").select(
        "id", F.coalesce("left", "lower").alias("left"), F.coalesce("right", "higher").alias("right")
    )
    known = nodes.select("id", "parent", "saved").join(children, "id", "left").join(siblings, "id", "left")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    down = F.struct(
        enter(F.col("id")).alias("arc"), F.coalesce(leave(F.col("left")), enter(F.col("parent"))).alias("before"),
        F.coalesce(enter(F.col("first")), leave(F.col("id"))).alias("after"), one.alias("arcs"),
        F.when(F.col("first").isNull(), one).otherwise(none).alias("leaves"), F.col("saved").alias("saved"),
    )
    up = F.struct(
        leave(F.col("id")).alias("arc"), F.coalesce(leave(F.col("last")), enter(F.col("id"))).alias("before"),
        F.coalesce(enter(F.col("right")), leave(F.col("parent"))).alias("after"), one.alias("arcs"), none.alias("leaves"), none.alias("saved"),
    )
    arcs = store(known.select(F.inline(F.array(down, up))), "arcs")
    discard(dealt)
    return arcs


# ---- list ranking ---------------------------------------------------------------------------

SUMS = ("arcs", "leaves", "saved")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums before every arc of a whole list; one task, ``TAIL_ARCS`` rows at most."""
    rows = {}
    for batch in batches:
        for arc, after, *weights in zip(*(batch.column(c).to_pylist() for c in ("arc", "after", *SUMS)), strict=True):
            rows[arc] = after, weights
    out, sums = [], np.zeros(len(SUMS), np.int64)
    arc = next(iter(set(rows) - {after for after, _ in rows.values()}), None)
    while arc is not None:
        out.append((arc, *sums.tolist()))
        arc, weights = rows[arc]
        sums = sums + weights
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["arc", *SUMS])


def contract(arcs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """One round: the arcs that stay, with what the arcs spliced out behind them weighed, and
    ``(arc, before, *sums)`` of those spliced out, their sums counted from the start of the arc
    before them. Priorities are hashes of the ids, so each row knows those of its neighbours."""
    priority = lambda c: F.xxhash64(F.lit(seed), F.col(c))
    lowest = F.col("before").isNotNull() & F.col("after").isNotNull() & (priority("arc") < priority("before")) & (priority("arc") < priority("after"))
    marked = store(arcs.withColumn("goes", lowest), "marked")
    gone = marked.where("goes").select("arc", "before", "after", *SUMS)
    stay = marked.where("not goes")
    behind = gone.select(F.col("before").alias("arc"), F.col("after").alias("new_after"), *[F.col(c).alias(f"more_{c}") for c in SUMS])
    ahead = gone.select(F.col("after").alias("arc"), F.col("before").alias("new_before"))
    joined = stay.join(behind, "arc", "left").join(ahead, "arc", "left")
    # Of the arc before a spliced one: what it weighed itself, for the way back.
    left = store(
        joined.select(
            "arc", F.coalesce("new_before", "before").alias("before"), F.coalesce("new_after", "after").alias("after"),
            *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in SUMS],
            F.when(F.col("new_after").isNotNull(), F.col("after")).alias("spliced"), *[F.col(c).alias(f"own_{c}") for c in SUMS],
        ),
        "left",
    )
    discard(marked)
    return left.select("arc", "before", "after", *SUMS), left


def rank(arcs: DataFrame, tail_arcs: int = TAIL_ARCS) -> DataFrame:
    """``(arc, *sums)``: the sums over all arcs before each one."""
    rounds, current, number = [], arcs, 0
    while current.count() > tail_arcs:
        number += 1
        current, spliced = contract(current, number)
        rounds.append(spliced)
    ranked = store(current.select("arc", "after", *SUMS).repartition(1).mapInArrow(_walk, "arc long, arcs long, leaves long, saved long"), "ranked")
    while rounds:
        spliced, before = rounds.pop(), ranked
        own = spliced.select("arc", "spliced", *[f"own_{c}" for c in SUMS]).where("spliced is not null")
        back = ranked.join(own, "arc").select(F.col("spliced").alias("arc"), *[(F.col(c) + F.col(f"own_{c}")).alias(c) for c in SUMS])
        ranked = store(ranked.unionByName(back), "ranked")
        discard(before, spliced)
    return ranked


# ---- the result -----------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, tail_arcs: int = TAIL_ARCS) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree, ``ends_sha256``, and
    ``enter``, ``leave``: the places of its arcs on the tour."""
    turns = turns_of(conversations)
    rebuilt, convs = share_heads(turns)
    named = store(prefixes(rebuilt), "named")
    nodes = nodes_of(named, convs)
    discard(turns, convs, named)
    arcs = tour(nodes)
    ranked = rank(arcs, tail_arcs)
    sign = F.when(F.col("arc") % 2 == 1, 1).otherwise(-1)
    place = lambda odd: F.max(F.when(F.col("arc") % 2 == odd, F.col("arcs")))
    spans = ranked.groupBy(F.shiftright("arc", 1).alias("id")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"), place(0).alias("enter"), place(1).alias("leave")
    )
    counts = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    result = nodes.join(spans, "id").join(counts, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256", "enter", "leave"
    )
    done = store(result, "trie")
    discard(nodes, arcs, ranked)
    return done


def trie_sql() -> str:
    """The same nodes in DuckDB's SQL, every prefix of a conversation written out."""
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])), "
        "lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"
    )
    return f"""WITH own AS (
  SELECT conv_id, list(struct_pack(d := md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
                                   w := len(regexp_extract_all(coalesce(text, ''), '{WORD}')))
                       ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {crc} % {HEADS} AS h, t FROM own),
rebuilt AS MATERIALIZED (SELECT a.conv_id, coalesce(b.t, [])[:a.h] || a.t[a.h + 1:] AS t FROM headed a LEFT JOIN own b ON b.conv_id = a.base),
prefixes AS MATERIALIZED (SELECT conv_id, depth, md5(array_to_string(list_transform(t[:depth], lambda x: x.d), ',')) AS node,
                                 md5(array_to_string(list_transform(t[:depth - 1], lambda x: x.d), ',')) AS parent,
                                 CASE WHEN depth > 0 THEN t[depth].w ELSE 0 END AS w, depth = len(t) AS ends
                          FROM (SELECT *, unnest(range(len(t) + 1)) AS depth FROM rebuilt)),
nodes AS MATERIALIZED (SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(w) AS saved,
                              sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
                       FROM prefixes GROUP BY depth, node),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
paths AS (SELECT n.depth AS at, n.node AS below, n.saved, c.n IS NULL AS leaf, p.depth, p.node
          FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
          JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
sums AS (SELECT depth, node, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM paths GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (depth, node) LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.parent"""
