"""Quality rules: text statistics, and decision lists learned from them by sequential covering.

A rule is a conjunction of thresholds on statistics, such as ``symbol_share >= 0.08 AND n_words >=
20``; a list of rules rejects a document by the first one that holds and keeps the others. Rules
are learned from labelled rows in two parts: a growing part, on which a rule takes one condition
after another by FOIL gain, and a pruning part, on which conditions that don't help are taken off
and the rule must prove itself. Rows that an accepted rule covers leave, and the next rule starts.

All counting is grouped aggregation in Spark: a step explodes every labelled row into one row per
statistic and bin, and what comes back is statistics x bins counts. Statistics and verdicts are
SQL expressions throughout.

Nulls: a null text has no words. A null id keeps its row and has no label. A null quality label is
no label; labels that repeat an id count as bad if any is. Without labels there are no rules and
only the base rules reject.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import WORD, empty_text
from shelfline.sources.shared import store

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
LEAST_COVERED = 4  # bad rows of the pruning part
STATISTICS = ("n_words", "mean_word", "symbol_share", "capital_share", "mark_share", "dup_line_share", "repeat_share", "distinct_share")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _covered(windows: Column, width: int) -> Column:
    """Words in windows that occur twice or more. Windows are hashes (64 bits: two different ones
    of a text are equal with a chance below one in a billion texts). Equal ones meet by sorting;
    their places in order then cover ``width`` words each, less what the one before covers."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(pairs: Column) -> Column:
        def repeated(x: Column, j: Column) -> Column:
            before = F.get(pairs, j - 1)["h"]
            after = F.get(pairs, j + 1)["h"]
            return F.when((x["h"].eqNullSafe(before)) | (x["h"].eqNullSafe(after)), x["i"])

        return F.sort_array(F.array_compact(F.transform(pairs, repeated)))

    def add(state: Column, place: Column) -> Column:
        return F.struct((state["n"] + F.least(F.lit(width), place - state["last"])).alias("n"), place.alias("last"))

    start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
    # transform over a one-element array binds the sorted pairs once
    bound = F.get(F.transform(F.array(ordered), places), F.lit(0))
    return F.aggregate(bound, start, add, lambda state: state["n"])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``, and
    the shares that rules use. A text without words has shares of zero."""
    text = F.col("text")
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_text(text_col).alias("text"))
    words = read.select("doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    hashed = words.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count(text, CAPITALS).alias("capitals"),
        _count(text, "!?.,;:").alias("marks"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    h = F.col("hashes")
    windowed = hashed.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
                lambda i: F.xxhash64(*[F.get(h, i + F.lit(k)) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    counted = windowed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "capitals", "marks",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("hashes")).alias("distinct_words"),
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0))
        .otherwise(_covered(F.col("windows"), WINDOW)).cast("long").alias("n_repeat_words"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("capitals", "word_chars").alias("capital_share"),
        share("marks", "word_chars").alias("mark_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("distinct_words", "n_words").alias("distinct_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


# ---- learning -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Iterable[Condition]) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule])


def thresholds(rows: DataFrame, statistics: tuple[str, ...], bins: int) -> dict[str, list[float]]:
    """Cut points of each statistic: quantiles of the bad rows and of the good rows."""
    points = sorted([0.005, 0.01, 0.02, 0.98, 0.99, 0.995, *(i / bins for i in range(1, bins))])
    quantiles = [
        F.percentile_approx(F.when(F.col("bad") == kind, F.col(s)), points, 2000).alias(f"{s}_{kind}") for s in statistics for kind in (True, False)
    ]
    found = rows.agg(*quantiles).first()
    return {s: sorted({float(v) for kind in (True, False) for v in (found[f"{s}_{kind}"] or [])}) for s in statistics}


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, float]:
    """The condition of the highest FOIL gain on ``rows`` and the share of bad rows under it."""

    def bin_of(statistic: str, points: list[float]) -> Column:
        return F.size(F.filter(F.lit(points), lambda point: point <= F.col(statistic)))

    binned = [
        F.struct(F.lit(i).alias("s"), bin_of(s, points).alias("bin"))
        for i, (s, points) in enumerate(cuts.items()) if points
    ]
    if not binned:
        return None, 0.0
    exploded = rows.select("bad", F.explode(F.array(*binned)).alias("at")).select("bad", "at.*")
    counts: dict[tuple[int, int], tuple[int, int]] = {
        (r["s"], r["bin"]): (r["bad"], r["good"])
        for r in exploded.groupBy("s", "bin").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
    }
    best, best_gain, best_share = None, 0.0, 0.0
    for i, (s, points) in enumerate(cuts.items()):
        per_bin = [counts.get((i, b), (0, 0)) for b in range(len(points) + 1)]
        bad, good = sum(b for b, _ in per_bin), sum(g for _, g in per_bin)
        if not bad:
            return None, 0.0
        below_bad = below_good = 0
        for point, (b, g) in zip(points, per_bin, strict=False):
            below_bad, below_good = below_bad + b, below_good + g
            for at_least, p, n in ((True, bad - below_bad, good - below_good), (False, below_bad, below_good)):
                if not p:
                    continue
                gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                if gain > best_gain + 1e-9:
                    best, best_gain, best_share = Condition(s, at_least, point), gain, p / (p + n)
    return best, best_share


def learn_rules(
    labelled: DataFrame, statistics: tuple[str, ...] = STATISTICS, bins: int = 24, max_rules: int = 12, max_conditions: int = 4,
    precision: float = 0.95, least_cover: float = 0.004,
) -> list[Rule]:
    """An ordered list of rules that reject, from ``(doc_id, bad, *statistics)``.

    ``precision`` is the share of bad rows among those that a rule covers in the pruning part;
    ``least_cover`` the share of the remaining bad rows that it must cover there.
    """
    part = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3))
    rows = store(labelled.select("doc_id", "bad", *statistics).withColumn("growing", part != 0), "labelled")
    cuts = thresholds(rows.where("growing"), statistics, bins)
    total = rows.where("bad").count()
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = reduce(lambda df, rule: df.where(~holds(rule)), rules, rows)
        grown, share, covered = [], 0.0, left.where("growing")
        while len(grown) < max_conditions and share < 0.999:
            condition, next_share = _best_condition(covered, cuts)
            if condition is None:
                break
            grown.append(condition)
            share, covered = next_share, covered.where(condition.column())
        if not grown:
            break
        # Pruning: the shortest beginning of the rule that does as well as the whole of it.
        tries = [grown[: n + 1] for n in range(len(grown))]
        counted = left.where(~F.col("growing")).agg(*[
            c for i, t in enumerate(tries)
            for c in (F.count_if(holds(t) & F.col("bad")).alias(f"p{i}"), F.count_if(holds(t) & ~F.col("bad")).alias(f"n{i}"))
        ]).first()
        worth = [(counted[f"p{i}"] / max(1, counted[f"p{i}"] + counted[f"n{i}"]), counted[f"p{i}"]) for i in range(len(tries))]
        best = max(range(len(tries)), key=lambda i: (round(worth[i][0], 3), -i))
        if worth[best][0] < precision or worth[best][1] < max(LEAST_COVERED, least_cover * total / 3):
            break
        rules.append(tuple(tries[best]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """False by the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    cases = reduce(lambda case, rule: case.when(holds(rule), False), rules[1:], F.when(holds(rules[0]), False))
    return cases.otherwise(True)


def fired(rules: list[Rule]) -> Column:
    """The text of the rule that rejects, or null."""
    if not rules:
        return F.lit(None).cast("string")
    texts = [(rule, " AND ".join(map(str, rule))) for rule in rules]
    return reduce(lambda case, pair: case.when(holds(pair[0]), pair[1]), texts[1:], F.when(holds(rules[0]), texts[0][1]))


def labelled_rows(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled documents with ``bad``; narrow rows, joined on the id."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    return statistics.join(marked, "doc_id")


def apply_quality_rules(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Statistics of every document with ``base_failed``, ``rule`` and ``kept``."""
    found = store(text_statistics(docs), "statistics")
    # Rows that the base rules reject need no learned one.
    rules = learn_rules(labelled_rows(found.where(~base_failed()), labels), **settings)
    return found.withColumns({"base_failed": base_failed(), "rule": fired(rules), "kept": ~base_failed() & verdict(rules)})
