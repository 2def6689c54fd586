"""Secret scans: fixed patterns, and random strings told from ordinary identifiers by two character
Markov models.

The fixed patterns are found in every text. Their values are the labelled samples of random
strings; long plain words of a bounded sample of texts, outside those values, are the samples of
ordinary identifiers. Each kind gives counts of character pairs, so a first-order Markov model; a
token is scored by the log-likelihood ratio of the two models per character pair. Tokens of at
least ``LEAST`` characters with a high ratio are reported as ``markov``.

Everything is SQL expressions and grouped aggregation. The models are a table of fixed size, one
ratio for each pair of ``ALPHABET``. Nulls: a null text is empty; null ids keep their rows. Without
samples of either kind the ratio is zero and nothing is added to the fixed patterns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.spans import SPAN, as_spans, joined, matches, outside, redact
from shelfline.llm.text import empty_text
from shelfline.sources.shared import store

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST = 16
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}+"
PLAIN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{8,}+(?![A-Za-z0-9+/_=-])"
SAMPLE_DOCUMENTS = 4_000
LEAST_RATIO = 1.0
PRIOR_PAIRS = 8
LEAST_DISTINCT = 8


def _value(match: Column) -> Column:
    return F.regexp_extract(match["value"], ASSIGN, 2)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, assign, access, hex, tokens)``: the matches of each kind, and the other long
    tokens outside of them. One pass over the texts; what stays is small."""
    text = F.col("text")
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_text(text_col).alias("text"))
    found = read.select(
        "doc_id",
        F.filter(matches(text, ASSIGN, text.contains("=") | text.contains(":")), lambda m: F.length(_value(m)) >= 6).alias("assign"),
        matches(text, ACCESS, text.contains("AKIA")).alias("access"),
        matches(text, HEX).alias("hex"),
        matches(text, TOKEN).alias("tokens"),
    )
    return found.withColumn("tokens", outside(F.col("tokens"), *[F.col(kind) for kind in KINDS]))


def _pairs(samples: DataFrame) -> DataFrame:
    """Counts of character pairs of ``(random, token)``."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring(F.col("token"), i, F.lit(2)))
    return samples.where(F.length("token") >= 2).select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").agg(F.count("*").alias("n"))


def train(found: DataFrame, docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """The log-likelihood ratio of every pair of ``ALPHABET``, random over ordinary, row by row.

    Random samples are all values that the fixed patterns found; ordinary ones are plain words of
    about ``sample_documents`` documents, chosen by a hash of their id.
    """
    values = F.concat(F.transform("assign", _value), F.transform("access", lambda m: m["value"]), F.transform("hex", lambda m: m["value"]))
    random = found.select(F.lit(True).alias("random"), F.explode(values).alias("token"))
    share = min(1.0, sample_documents / max(1, found.count()))
    chosen = docs.where(F.pmod(F.xxhash64(F.lit(3), id_col), F.lit(1 << 20)) < int(share * (1 << 20)))
    ordinary = chosen.select(F.lit(False).alias("random"), F.explode(F.regexp_extract_all(empty_text(text_col), F.lit(PLAIN), F.lit(0))).alias("token"))
    counts = {True: {}, False: {}}
    for row in _pairs(random.unionByName(ordinary)).collect():  # at most two rows per pair of characters
        counts[row["random"]][row["pair"]] = row["n"]
    size = len(ALPHABET)
    if not counts[True] or not counts[False]:
        return [0.0] * (size * size)

    singles = {kind: {b: sum(found.get(a + b, 0) for a in ALPHABET) for b in ALPHABET} for kind, found in counts.items()}
    starts = {kind: {a: sum(found.get(a + b, 0) for b in ALPHABET) for a in ALPHABET} for kind, found in counts.items()}

    def chance(kind: bool, a: str, b: str) -> float:
        """Of ``b`` after ``a``; where ``a`` was seen little, mostly the chance of ``b`` alone."""
        alone = (singles[kind][b] + 0.5) / (sum(singles[kind].values()) + 0.5 * size)
        return math.log((counts[kind].get(a + b, 0) + PRIOR_PAIRS * alone) / (starts[kind][a] + PRIOR_PAIRS))

    return [chance(True, a, b) - chance(False, a, b) for a in ALPHABET for b in ALPHABET]


def ratio(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's character pairs."""
    size = len(ALPHABET)
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def mean(places: Column) -> Column:
        n = F.size(places) - 1
        each = F.zip_with(F.slice(places, F.lit(1), n), F.slice(places, F.lit(2), n), lambda a, b: F.get(F.lit(model), a * size + b))
        return F.aggregate(each, F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0))) / n

    return F.get(F.transform(F.array(codes), mean), F.lit(0))


def is_random(token: Column, model: list[float], least_ratio: float = LEAST_RATIO) -> Column:
    varied = F.size(F.array_distinct(F.split(token, ""))) >= LEAST_DISTINCT
    return varied & (ratio(token, model) >= least_ratio)


def judge(found: DataFrame, model: list[float], least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base, spans)``: spans in order of start, then kind."""

    def ordered(*kinds: Column) -> Column:
        ranked = F.concat(*[_ranked(spans, rank) for rank, spans in enumerate(kinds)])
        return F.transform(F.sort_array(ranked), lambda x: x["span"]).cast(SPAN)

    base = [as_spans(F.col(kind), kind) for kind in KINDS]
    extra = as_spans(F.filter("tokens", lambda m: is_random(m["value"], model, least_ratio)), "markov")
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        ordered(*base).alias("base"), ordered(*base, extra).alias("spans"),
    )


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s.alias("span")))


def find_secrets(docs: DataFrame, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base, spans)`` for every document."""
    found = store(scan(docs), "secrets")
    return judge(found, train(found, docs), least_ratio)


def digests(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with all secret spans of its texts replaced and ``n_chars`` counted anew. The
    models are trained from one scan; the texts are then scanned again where they are, so no text
    is shuffled."""
    model = train(store(scan(docs), "secrets"), docs)
    text, columns = empty_text(), docs.columns
    held = docs.withColumns({
        "__assign": F.filter(matches(text, ASSIGN, text.contains("=") | text.contains(":")), lambda m: F.length(_value(m)) >= 6),
        "__access": matches(text, ACCESS, text.contains("AKIA")),
        "__hex": matches(text, HEX),
        "__tokens": F.filter(matches(text, TOKEN), lambda m: is_random(m["value"], model)),
    })
    spans = F.concat(*[as_spans(F.col(f"__{kind}"), kind) for kind in (*KINDS, "tokens")])
    changed = held.withColumn("__spans", spans).withColumn("__text", F.when(F.col("text").isNotNull(), redact(text, F.col("__spans"), mark)))
    count = F.when(F.size("__spans") > 0, F.length("__text").cast("long")).otherwise(F.col("n_chars"))
    return changed.select(*[F.col("__text").alias(c) if c == "text" else count.alias(c) if c == "n_chars" else F.col(c) for c in columns])
