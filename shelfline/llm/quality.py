"""Quality classifier with hierarchical empirical Bayes.

A document has evidence of its own: the log-likelihood ratio of its text statistics, good over bad,
from a naive Bayes classifier on binned statistics. Its site has evidence too: the share of good
documents on its path and its host. Small sites say little, so their shares are shrunk towards the
level above them,

    posterior(path) = (good(path) + k_path * posterior(host)) / (n(path) + k_path)
    posterior(host) = (good(host) + k_host * prior) / (n(host) + k_host)

where the strengths ``k`` come from the spread of the shares between the sites of a level (method
of moments): the more alike the sites, the stronger the pull. ``good`` counts labelled documents by
their label and all others by the classifier's chance, at ``SOFT_WEIGHT`` of a label. The score is
the chance of good from the document's ratio and its path's odds.

All of it is grouped aggregation over two scans of the texts; sites are joined to documents from
stored tables, so Spark broadcasts them only if they are small.

Nulls: a null text is empty, a null host or path is a site of its own. Null quality is no label;
labels that repeat an id count as bad if any is. A text without words has the ratio of its bins
like any other. Without labels of both kinds every score is the prior, 0.5, and all are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import WORD, empty_text
from shelfline.sources.shared import store

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = ("symbol_share", "capital_share", "shout_share", "repetition")
BINS = 12
SOFT_WEIGHT = 0.1
KEEP_SCORE = 0.5
MOST_STRENGTH = 1e4
LARGEST_RATIO = 4.0  # of one statistic: they are not independent, so none decides alone twice over


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``__s`` of shares; zero for texts without words."""
    text = empty_text(text_col)
    read = docs.withColumns({
        "__words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        "__chars": F.length(F.translate(text, BLANKS, "")),
        "__symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "__capitals": F.length(text) - F.length(F.translate(text, CAPITALS, "")),
        "__shouts": F.length(text) - F.length(F.translate(text, "!", "")),
    })
    words = read.withColumns({
        "__extra_capitals": F.greatest(F.lit(0), F.col("__capitals") - F.size("__words")),
        "__n": F.size("__words"),
        "__distinct": F.size(F.array_distinct(F.transform("__words", lambda w: F.xxhash64(w)))),
    })

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    shares = F.struct(
        share("__symbols", "__chars").alias("symbol_share"),
        # capitals beyond one per word, so that a short text with one sentence is no shouting
        share("__extra_capitals", "__chars").alias("capital_share"),
        share("__shouts", "__n").alias("shout_share"),
        share("__n", "__distinct").alias("repetition"),
    )
    return words.withColumn("__s", shares).select(*docs.columns, "__s")


@dataclass(frozen=True)
class Classifier:
    """Cut points of each statistic and the log-likelihood ratio of each bin, good over bad."""

    cuts: dict[str, list[float]]
    ratios: dict[str, list[float]]

    def ratio(self) -> Column:
        """The ratio of a row with the struct ``__s``."""
        total = F.lit(0.0)
        for name, points in self.cuts.items():
            value = F.col("__s")[name]
            case = F.lit(self.ratios[name][len(points)])
            for i in reversed(range(len(points))):
                case = F.when(value < points[i], self.ratios[name][i]).otherwise(case)
            total = total + case
        return total


def train(labelled: DataFrame, bins: int = BINS) -> Classifier:
    """From ``(good, __s)`` rows: bins at the quantiles of both kinds, counts by grouped sums."""
    points = [0.01, *(i / bins for i in range(1, bins)), 0.99]
    quantiles = [
        F.percentile_approx(F.when(F.col("good") == kind, F.col("__s")[s]), points, 2000).alias(f"{s}_{kind}") for s in STATISTICS for kind in (True, False)
    ]
    found = labelled.agg(*quantiles).first()
    cuts = {s: sorted({float(v) for kind in (True, False) for v in (found[f"{s}_{kind}"] or [])}) for s in STATISTICS}

    def bin_of(name: str) -> Column:
        return F.size(F.filter(F.lit(cuts[name]), lambda point: point <= F.col("__s")[name]))

    bins_of = [F.struct(F.lit(s).alias("s"), bin_of(s).alias("bin")) for s in STATISTICS if cuts[s]]
    if not bins_of:
        return Classifier({}, {})
    rows = labelled.select("good", F.explode(F.array(*bins_of)).alias("at")).groupBy("at.s", "at.bin").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    ).collect()  # statistics x bins
    counts = {(r["s"], r["bin"]): (r["good"], r["bad"]) for r in rows}
    ratios = {}
    for s in STATISTICS:
        cells = [counts.get((s, b), (0, 0)) for b in range(len(cuts[s]) + 1)]
        good, bad = (sum(c[i] for c in cells) for i in (0, 1))
        if not good or not bad:
            return Classifier({}, {})
        each = [math.log((g + 1) / (good + len(cells))) - math.log((b + 1) / (bad + len(cells))) for g, b in cells]
        ratios[s] = [max(-LARGEST_RATIO, min(LARGEST_RATIO, r)) for r in each]
    return Classifier(cuts, ratios)


def _strength(n: str, good: str, mean: Column) -> Column:
    """How many documents the level above is worth: method of moments for shares around ``mean``.

    With sizes ``n`` and shares ``s``, ``sum n (s - mean)^2`` is expected to be ``sum v`` by chance
    alone, where ``v = mean (1 - mean)``, and ``(sum n - sum n^2 / sum n) t`` more if the sites'
    own shares differ by a variance ``t``. The strength is then ``v / t - 1``.
    """
    size, chance = F.col(n), mean * (1 - mean)
    spread = F.sum(size * (F.col(good) / size - mean) ** 2)
    between = (spread - F.sum(chance)) / F.greatest(F.lit(1e-9), F.sum(size) - F.sum(size * size) / F.sum(size))
    estimated = F.greatest(F.lit(1.0), F.avg(chance) / between - 1)
    return F.when(between > 0, F.least(F.lit(MOST_STRENGTH), estimated)).otherwise(F.lit(MOST_STRENGTH))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """``(host, path, path_posterior)`` and the prior, from rows ``(host, path, weight, good)``
    where ``good`` is the weighted chance of good."""
    paths = store(evidence.groupBy("host", "path").agg(F.sum("weight").alias("n"), F.sum("good").alias("g")), "paths")
    whole = paths.agg(F.sum("n").alias("n"), F.sum("g").alias("g")).first()
    prior = (whole["g"] / whole["n"]) if whole["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    k_host = hosts.agg(_strength("n", "g", F.lit(prior)).alias("k")).first()["k"] or MOST_STRENGTH
    posterior = hosts.select(F.col("host").alias("h"), ((F.col("g") + k_host * prior) / (F.col("n") + k_host)).alias("host_posterior"))
    joined = store(paths.join(posterior, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "hosts")
    k_path = joined.agg(_strength("n", "g", F.col("host_posterior")).alias("k")).first()["k"] or MOST_STRENGTH
    shrunk = (F.col("g") + k_path * F.col("host_posterior")) / (F.col("n") + k_path)
    return store(joined.select("host", "path", "host_posterior", shrunk.alias("path_posterior")), "sites"), prior


def _chance(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), log_odds))))


def _log_odds(chance: Column) -> Column:
    held = F.least(F.lit(0.999), F.greatest(F.lit(0.001), chance))
    return F.log(held / (1 - held))


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """``docs`` with ``__ratio``, ``__site`` (the path's posterior) and ``__score``.

    ``host`` and ``path`` are expressions over the columns of ``docs``.
    """
    placed = with_statistics(docs.withColumns({"__host": host.cast("string"), "__path": path.cast("string")}))
    marked = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("__id")).agg((F.min("quality") == 1).alias("good"))
    narrow = store(placed.select("doc_id", F.col("__host").alias("host"), F.col("__path").alias("path"), "__s"), "quality")
    known = narrow.join(marked, F.col("doc_id") == F.col("__id"), "left")
    classifier = train(known.where("good is not null").select("good", "__s"))
    if not classifier.cuts:
        return docs.withColumns({"__ratio": F.lit(0.0), "__site": F.lit(0.5), "__score": F.lit(0.5)})
    shares = known.where("good is not null").agg(F.avg(F.col("good").cast("double"))).first()[0]
    start = math.log((shares + 1e-3) / (1 - shares + 1e-3))
    soft = _chance(classifier.ratio() + start)
    weight = F.when(F.col("good").isNotNull(), F.lit(1.0)).otherwise(F.lit(SOFT_WEIGHT))
    good = F.when(F.col("good").isNotNull(), F.col("good").cast("double")).otherwise(soft)
    sites, _ = site_posteriors(known.select("host", "path", weight.alias("weight"), (weight * good).alias("good")))
    judged = placed.withColumn("__ratio", classifier.ratio()).drop("__s").join(
        sites.withColumnsRenamed({"host": "__h", "path": "__p", "path_posterior": "__site"}).drop("host_posterior"),
        F.col("__host").eqNullSafe(F.col("__h")) & F.col("__path").eqNullSafe(F.col("__p")),
    )
    scored = judged.withColumn("__score", _chance(F.col("__ratio") + _log_odds(F.col("__site"))))
    return scored.select(*docs.columns, "__ratio", "__site", "__score")


def by_source_and_language(docs: DataFrame) -> tuple[Column, Column]:
    """The sites of ``documents``, which have no address: the source is the host, and the source
    with the language is the path."""
    return F.col("source"), F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, keep: float = KEEP_SCORE) -> DataFrame:
    """``(doc_id, text_ratio, site_posterior, score, kept)`` for every document."""
    scored = score(docs.select("doc_id", "text", "source", "lang"), labels, *by_source_and_language(docs))
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("__ratio").alias("text_ratio"), F.col("__site").alias("site_posterior"),
        F.col("__score").alias("score"), (F.col("__score") >= keep).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP_SCORE) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns."""
    return score(docs, labels, *by_source_and_language(docs)).where(F.col("__score") >= keep).select(*docs.columns)
