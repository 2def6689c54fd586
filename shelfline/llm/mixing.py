"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves of a tree, for ``documents`` domain / language / source. A budget of tokens
goes down the tree by weight. A node cannot spend more than its documents hold, over at most
``max_epochs`` readings; what it cannot spend goes to its siblings by their weights, and only what
all siblings together cannot spend goes back to the parent's siblings. Level by level that is water
filling among the children of a node: with weights ``w`` and capacities ``c``, child ``i`` gets
``min(c_i, x * w_i)`` with one ``x`` per node. Sorted by ``c / w`` the children that are full come
first, so running sums give ``x`` (a window over the nodes, not over documents).

A leaf then reads its documents in an order seeded per epoch, whole epochs first, and of the last
epoch the longest prefix that its tokens pay for. The prefix is found without sorting a leaf: tokens
are summed per leaf and slice of the order, slices before the cut are taken whole, and only the
documents of the slice with the cut are put in order. The cut becomes one key per leaf, so
choosing documents compares keys and moves no text.

Weights are whole numbers; nodes without one weigh 1. Nulls: a null level value is a node of its
own. A null text has no tokens; documents without tokens come with the place they have in the
order. Rows that repeat an id have the same place and are taken or left together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.text import WORD, empty_text
from shelfline.sources.shared import store

SEED = 20
NONE = "(none)"
SLICE_DOCUMENTS = 4_000


@dataclass(frozen=True)
class Mix:
    """Levels of the tree from the root down, and weights of nodes by level and value."""

    levels: tuple[str, ...]
    weights: dict[str, dict[str, int]]
    max_epochs: int = 1
    seed: int = SEED

    def weight(self, level: str) -> Column:
        case = F.lit(1)
        for value, weight in self.weights.get(level, {}).items():
            case = F.when(F.col(level) == value, weight).otherwise(case)
        return case.cast("long")


def place_key(seed: int, epoch: Column, id_col: Column) -> Column:
    """The place of a document in an epoch's order: 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit(""))))


def token_count(text_col: str = "text") -> Column:
    return F.size(F.regexp_extract_all(empty_text(text_col), F.lit(WORD), F.lit(0))).cast("long")


def allocate(leaves: DataFrame, mix: Mix, budget: int) -> DataFrame:
    """``(*levels, capacity, budget)`` for every leaf ``(*levels, capacity)``."""
    placed = leaves.select(*mix.levels, "capacity").withColumn("budget", F.lit(budget).cast("long"))
    for depth, level in enumerate(mix.levels):
        above, here = list(mix.levels[:depth]), list(mix.levels[: depth + 1])
        nodes = placed.groupBy(*here).agg(F.sum("capacity").alias("__c"), F.min("budget").alias("__b")).withColumn("__w", mix.weight(level))
        family = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        ratio = F.col("__c") / F.col("__w")
        before = family.orderBy(ratio, level).rowsBetween(Window.unboundedPreceding, -1)
        filled = nodes.select(
            "*",
            F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__full_c"), F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__full_w"),
            F.sum("__w").over(family).alias("__all_w"),
        )
        # If the children before this one in the order are full, this is x; the first child whose
        # own ratio reaches it settles it for the node. Without one, all are full.
        x = (F.col("__b") - F.col("__full_c")) / (F.col("__all_w") - F.col("__full_w"))
        tried = filled.withColumn("__tried", F.when(ratio >= x, F.struct(ratio.alias("ratio"), F.col(level).alias("node"), x.alias("x"))))
        settled = tried.withColumn("__x", F.min("__tried").over(family)["x"])
        share = F.when(F.col("__x").isNull(), F.col("__c")).otherwise(F.least("__c", F.floor(F.col("__x") * F.col("__w"))))
        given = settled.select(*here, share.cast("long").alias("budget"))
        placed = placed.drop("budget").join(given, here)
    return placed.select(*mix.levels, "capacity", "budget")


def _keyed(df: DataFrame, mix: Mix) -> DataFrame:
    return df.withColumns({level: F.coalesce(F.col(level).cast("string"), F.lit(NONE)) for level in mix.levels})


def cuts(sizes: DataFrame, mix: Mix, budget: int) -> DataFrame:
    """``(*levels, whole, cut)``: how many whole epochs a leaf reads, and the key up to which it
    reads the next one (null: not at all), from ``(doc_id, n_tokens, *levels)``."""
    levels = list(mix.levels)
    sums = store(sizes.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    budgets = allocate(sums.withColumn("capacity", F.col("tokens") * mix.max_epochs), mix, budget)
    leaves = store(
        budgets.join(sums, levels).select(
            *levels, "tokens",
            F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(mix.max_epochs)).cast("long").alias("whole"),
            F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)).alias("rest"),
        ),
        "budgets",
    )
    largest = sums.agg(F.max("docs")).first()[0] or 0
    digits = 1
    while largest > SLICE_DOCUMENTS * 16**digits:
        digits += 1
    keyed = sizes.join(leaves, levels).where("rest > 0").withColumn("key", place_key(mix.seed, F.col("whole"), F.col("doc_id")))
    sliced = keyed.withColumn("slice", F.substring("key", 1, digits))
    totals = store(sliced.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest")), "slices")
    running = Window.partitionBy(*levels).orderBy("slice")
    marked = totals.withColumn("upto", F.sum("t").over(running))
    # The first slice that the rest does not pay for as a whole; one at most per leaf.
    at_cut = marked.where("upto > rest").groupBy(*levels).agg(F.min(F.struct("slice", (F.col("upto") - F.col("t")).alias("before"))).alias("at"))
    inside = sliced.join(at_cut, levels).where("slice = at.slice")
    order = Window.partitionBy(*levels).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    paid = inside.withColumn("sum", F.col("at.before") + F.sum("n_tokens").over(order)).where("sum <= rest")
    last = paid.groupBy(*levels).agg(F.max("key").alias("last"))
    # Keys start with their slice, so the slice itself stands for all keys before it.
    return store(
        leaves.join(at_cut, levels, "left").join(last, levels, "left").select(
            *levels, "whole", F.when(F.col("rest") > 0, F.coalesce("last", "at.slice", F.lit("g"))).alias("cut")
        ),
        "cuts",
    )


def select_epochs(docs: DataFrame, mix: Mix, leaf_cuts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each time that it is read, with ``__epoch``. ``docs`` has the level
    columns (named ``__`` and the level)."""
    on = [F.coalesce(docs[f"__{level}"].cast("string"), F.lit(NONE)) == leaf_cuts[level] for level in mix.levels]
    placed = docs.join(leaf_cuts, on).drop(*[leaf_cuts[level] for level in mix.levels])
    next_epoch = (place_key(mix.seed, placed["whole"], placed[id_col]) <= F.col("cut")).cast("int")
    times = F.col("whole") + F.coalesce(next_epoch, F.lit(0))
    return placed.withColumn("__times", times.cast("int")).where("__times > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(0), F.col("__times") - 1)).alias("__epoch")
    )


# ---- documents ------------------------------------------------------------------------------

# ``documents`` names no domain, so sources are dealt to three of them by their number.
DOMAINS = ("web", "books", "forums")
MIX = Mix(
    levels=("domain", "lang", "source"),
    weights={"domain": {"web": 5, "books": 3, "forums": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}},
    max_epochs=2,
)


def domain_of(source: Column) -> Column:
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    case = F.lit(DOMAINS[0])
    for i, name in enumerate(DOMAINS[1:], 1):
        case = F.when(F.try_to_number(number, F.lit("999999999")) % len(DOMAINS) == i, name).otherwise(case)
    return case


def _leaves(docs: DataFrame) -> dict[str, Column]:
    return {"domain": domain_of(docs["source"]), "lang": docs["lang"], "source": docs["source"]}


def sizes_of(docs: DataFrame, mix: Mix) -> DataFrame:
    """``(doc_id, n_tokens, *levels)``, stored: all that budgeting reads."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), token_count().alias("n_tokens"), *[c.alias(n) for n, c in _leaves(docs).items()])
    return store(_keyed(narrow, mix), "sizes")


def budget_of(sizes: DataFrame, share: float) -> int:
    """A share of all tokens, in whole tokens."""
    return int((sizes.agg(F.sum("n_tokens")).first()[0] or 0) * share)


def mix_documents(docs: DataFrame, share: float, mix: Mix = MIX) -> DataFrame:
    """``(doc_id, domain, lang, source, n_tokens, epoch)``: one row for each time that a document
    is read when ``share`` of all tokens are to be read by the weights of ``mix``."""
    sizes = sizes_of(docs, mix)
    named = sizes.withColumnsRenamed({level: f"__{level}" for level in mix.levels})
    chosen = select_epochs(named, mix, cuts(sizes, mix, budget_of(sizes, share)))
    return chosen.select("doc_id", *[F.col(f"__{level}").alias(level) for level in mix.levels], "n_tokens", F.col("__epoch").cast("long").alias("epoch"))


def least_whole_budget(sizes: DataFrame, mix: Mix) -> int:
    """The smallest budget that, spent by the weights, reads every document at least once.

    From the leaves up: a node gives each child in proportion to its weight, so it needs the
    largest ratio of need to weight among its children; the others get as much of that as they
    can hold. Two tokens more per child make up for rounding on the way down.
    """
    placed = sizes.groupBy(*mix.levels).agg(F.sum("n_tokens").alias("need")).withColumn("capacity", F.col("need") * mix.max_epochs)
    for depth in reversed(range(len(mix.levels))):
        above, level = list(mix.levels[:depth]), mix.levels[depth]
        asked = F.least("capacity", F.col("need") + 2)
        children = placed.withColumns({"__w": mix.weight(level), "__asked": asked})
        highest = children.groupBy(*above).agg(F.max(F.col("__asked") / F.col("__w")).alias("__x"))
        joined = children.join(highest, above) if above else children.withColumn("__x", highest.scalar())
        given = F.least("capacity", F.ceil(F.col("__x") * F.col("__w")))
        placed = joined.groupBy(*above).agg(F.sum(given).cast("long").alias("need"), F.sum("capacity").alias("capacity"))
    return int(placed.first()["need"] or 0)


def take_mix(docs: DataFrame, mix: Mix = MIX) -> DataFrame:
    """The rows of ``docs`` that the mix reads, with their columns, once per reading. The budget is
    ``least_whole_budget``: every document is read, and short leaves are read again, up to
    ``max_epochs`` times, until the weights hold as far as they can."""
    sizes = sizes_of(docs, mix)
    leaf_cuts = cuts(sizes, mix, least_whole_budget(sizes, mix))
    named = docs.withColumns({f"__{name}": column for name, column in _leaves(docs).items()})
    return select_epochs(named, mix, leaf_cuts).select(*docs.columns)


def mix_sql(share: float, mix: Mix = MIX) -> str:
    """The same in DuckDB's SQL, with the order of whole leaves in one window each."""
    weights = {
        level: "CASE " + " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in mix.weights.get(level, {}).items()) + " ELSE 1 END"
        if mix.weights.get(level) else "1"
        for level in mix.levels
    }
    domains = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(DOMAINS))
    steps = [
        "sizes AS (SELECT doc_id, "
        f"CASE coalesce(try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT) % {len(DOMAINS)}, 0) {domains} END AS domain, "
        f"coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source, "
        "CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents)",
        f"total AS (SELECT CAST(floor(sum(n_tokens) * CAST({share} AS DOUBLE)) AS BIGINT) AS b FROM sizes)",
        f"leaves AS (SELECT {', '.join(mix.levels)}, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM sizes GROUP BY ALL)",
        f"placed0 AS (SELECT leaves.*, CAST(tokens * {mix.max_epochs} AS BIGINT) AS capacity, b AS budget FROM leaves, total)",
    ]
    for depth, level in enumerate(mix.levels):
        above, here = mix.levels[:depth], mix.levels[: depth + 1]
        family = f"PARTITION BY {', '.join(above)}" if above else ""
        steps += [
            f"nodes{depth} AS (SELECT {', '.join(here)}, CAST(sum(capacity) AS BIGINT) AS c, min(budget) AS b, CAST({weights[level]} AS BIGINT) AS w "
            f"FROM placed{depth} GROUP BY {', '.join(here)})",
            f"filled{depth} AS (SELECT *, coalesce(sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_c, "
            f"coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_w, sum(w) OVER ({family}) AS all_w, row_number() OVER o AS place "
            f"FROM nodes{depth} WINDOW o AS ({family} ORDER BY c / w, {level}))",
            f"tried{depth} AS (SELECT *, CASE WHEN c / w >= CAST(b - full_c AS DOUBLE) / CAST(all_w - full_w AS DOUBLE) "
            f"THEN CAST(b - full_c AS DOUBLE) / CAST(all_w - full_w AS DOUBLE) END AS x0 FROM filled{depth})",
            f"settled{depth} AS (SELECT *, arg_min(x0, CASE WHEN x0 IS NOT NULL THEN place END) OVER ({family}) AS x FROM tried{depth})",
            f"given{depth} AS (SELECT {', '.join(here)}, CAST(CASE WHEN x IS NULL THEN c ELSE least(c, CAST(floor(x * w) AS BIGINT)) END AS BIGINT) AS budget FROM settled{depth})",
            f"placed{depth + 1} AS (SELECT p.* REPLACE (g.budget AS budget) FROM placed{depth} p JOIN given{depth} g USING ({', '.join(here)}))",
        ]
    last = len(mix.levels)
    steps += [
        f"budgets AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE {mix.max_epochs} END AS whole, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM placed{last})",
        f"ordered AS (SELECT s.*, whole, rest, sum(s.n_tokens) OVER (PARTITION BY {', '.join(mix.levels)} "
        f"ORDER BY md5(concat_ws(':', '{mix.seed}', CAST(whole AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto "
        f"FROM sizes s JOIN budgets USING ({', '.join(mix.levels)}))",
        "timed AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM ordered)",
    ]
    return (
        "WITH " + ",\n".join(steps)
        + f"\nSELECT doc_id, {', '.join(mix.levels)}, n_tokens, CAST(unnest(range(times)) AS BIGINT) AS epoch FROM timed WHERE times > 0"
    )
