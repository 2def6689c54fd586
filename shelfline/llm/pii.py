"""Personal data: fixed patterns, and bootstrapped contextual extraction.

The fixed patterns (email, ip, card, phone) are found in every text; their matches are the seed
entities. Bootstrapping then looks at a graph of lexical patterns and instances:

- an instance is a token with a digit or an at sign, or a seed;
- a pattern is the word before it (``word _``), the two words before it (``two words _``), the word
  after it (``_ word``), its shape (``[A99]``: letters by runs, digits and marks one by one), or the
  word before together with the shape;
- a pattern of words alone has to announce instances: of its occurrences in all documents at least
  ``SPECIFIC`` stand beside one;
- seeds are believed; a pattern is believed as far as the share of its distinct instances that are
  believed; an instance is believed in the next round as far as the best pattern that found it.

A pattern must extract at least ``LEAST_SUPPORT`` believed instances; that bar is the same at every
size of the corpus. After ``ROUNDS`` rounds, every token in the context of a pattern of at least
``CONFIDENCE`` is reported as ``context`` where it overlaps no base span. Patterns stay a stored
table that tokens are joined with, whatever their number. All of it is SQL expressions, joins and
grouped aggregation; links are counted per pattern and instance before they are joined, and only
words that can be patterns are counted over the documents.

Nulls: a null text is empty; null and repeated ids keep their rows. Without seeds no pattern passes
and only the fixed patterns report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.spans import AROUND, SPAN, as_spans, joined, matches, outside, redact
from shelfline.llm.text import BLANK, WORD, empty_text
from shelfline.sources.shared import discard, store

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
LABEL = "A-Za-z0-9-"
# On texts whose doubled dots are replaced: dots stand alone, so a domain is a run of one class.
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++\.[{LABEL}.]*[{LABEL}]"
DOUBLED_DOTS = r"\.(?=\.)|(?<=\.)\."
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP_IN_RANGE = rf"^{PART}(?:\.{PART}){{3}}$"
# On texts whose doubled separators are replaced: digits and single separators are one run.
CARD = r"[0-9][0-9 -]*[0-9]"
DOUBLED_BLANKS = r"\x20(?=[ -])|(?<=[ -])\x20"  # become tabs, so that words still end there
DOUBLED_HYPHENS = r"-(?=[ \t-])|(?<=[ \t-])-"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TOKEN = rf"(?<![^{BLANK}])[^{BLANK}0-9@]*+[0-9@][^{BLANK}]*+"

ROUNDS = 3
SPECIFIC = 0.3
LEAST_SUPPORT = 5
CONFIDENCE = 0.6
SMALL_TABLE = 100_000  # so many patterns at most are sent to every task


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def weigh(digit: Column, i: Column) -> Column:
        doubled = digit.cast("int") * 2
        return F.when(i % 2 == 0, digit.cast("int")).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weigh), F.lit(0), lambda a, b: a + b) % 10 == 0


def base_matches(text: Column) -> dict[str, Column]:
    """The matches of each kind that pass its test."""
    digit = text.rlike("[0-9]")
    dotted = F.when(text.contains(".."), F.regexp_replace(text, DOUBLED_DOTS, "_")).otherwise(text)
    single = F.when(digit, F.regexp_replace(F.regexp_replace(text, DOUBLED_BLANKS, "\t"), DOUBLED_HYPHENS, "_")).otherwise(F.lit(""))

    def valid_card(m: Column) -> Column:
        digits = _digits(m["value"])
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)

    return {
        "email": matches(dotted, EMAIL, text.contains("@"), text, around=True),
        "ip": F.filter(matches(text, IP, digit, around=True), lambda m: m["value"].rlike(IP_IN_RANGE)),
        "card": F.filter(matches(single, CARD, digit, text, around=True), valid_card),
        "phone": F.filter(matches(text, PHONE, text.contains("+"), around=True), lambda m: F.length(_digits(m["value"])).between(8, 15)),
    }


def _trimmed(found: Column) -> Column:
    """Tokens without the punctuation around them, if a digit or at sign is left."""
    inner = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), m["left"].alias("left"), m["left2"].alias("left2"), m["right"].alias("right"),
        F.regexp_extract(m["value"], r"^[\"'(\[{<]*", 0).alias("head"),
        F.regexp_replace(F.regexp_replace(m["value"], r"^[\"'(\[{<]+", ""), r"[\"')\]}>.,;:!?]++$", "").alias("value"),
    ))
    placed = F.transform(inner, lambda m: F.struct(
        (m["start"] + F.length(m["head"])).alias("start"),
        (m["start"] + F.length(m["head"]) + F.length(m["value"])).alias("end"),
        m["value"].alias("value"), m["left"].alias("left"), m["left2"].alias("left2"), m["right"].alias("right"),
    ))
    return F.filter(placed, lambda m: F.length(m["value"]) > 0).cast(AROUND)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, email, ip, card, phone, tokens)``: the matches of each kind, and the tokens with
    a digit or an at sign outside of them. One pass over the texts; what stays is small."""
    text = F.col("text")
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_text(text_col).alias("text"))
    found = read.select(
        "doc_id", *[c.alias(kind) for kind, c in base_matches(text).items()],
        matches(text, TOKEN, text.rlike("[0-9@]"), around=True).alias("tokens"),
    )
    return found.withColumn("tokens", outside(_trimmed(F.col("tokens")), *[F.col(kind) for kind in KINDS]))


# ---- bootstrapping --------------------------------------------------------------------------


def shape(value: Column) -> Column:
    """Runs of upper-case letters as ``A``, of others as ``a``, digits as ``9``, marks as they are."""
    letters = F.regexp_replace(F.regexp_replace(value, r"\p{Lu}++", "A"), r"[\p{L}&&[^A]]++", "a")
    return F.regexp_replace(letters, "[0-9]", "9")


def patterns_of(m: Column) -> Column:
    """The patterns that a match is an instance of."""
    named = lambda word: word.rlike(r"\p{L}")
    shaped = F.concat(F.lit("["), shape(m["value"]), F.lit("]"))
    every = F.array(
        F.when(named(m["left"]), F.concat(m["left"], F.lit(" _"))), F.when(named(m["left2"]), F.concat(m["left2"], F.lit(" _"))),
        F.when(named(m["right"]), F.concat(F.lit("_ "), m["right"])), shaped, F.when(named(m["left"]), F.concat(m["left"], F.lit(" "), shaped)),
    )
    return F.filter(every, lambda p: p.isNotNull())


def of_words(pattern: Column) -> Column:
    """Whether a pattern is one of words alone."""
    return pattern.endswith(" _") | pattern.startswith("_ ")


def occurrences(found: DataFrame) -> DataFrame:
    """``(pattern, instance, seed)``, a row for each time that a pattern finds an instance."""

    def linked(kind: str, seed: bool) -> Column:
        return F.transform(kind, lambda m: F.struct(patterns_of(m).alias("patterns"), m["value"].alias("instance"), F.lit(seed).alias("seed")))

    each = found.select(F.explode(F.concat(*[linked(kind, True) for kind in KINDS], linked("tokens", False))).alias("m"))
    return each.select(F.explode("m.patterns").alias("pattern"), "m.instance", "m.seed")


def pattern_graph(found: DataFrame) -> DataFrame:
    """``(pattern, instance, seed, times)``: the distinct links between patterns and instances."""
    return occurrences(found).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("times"))


def announcing_patterns(links: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pattern)``: those that may pass. A pattern with fewer than ``LEAST_SUPPORT`` distinct
    instances cannot pass later, so it is no candidate. Patterns of words are counted over all
    documents: words meet the candidates first, so few of them are added up, and if there are too
    many candidates to send to every task the words are added up first."""
    candidates = store(
        links.groupBy("pattern").agg(F.count("*").alias("instances"), F.sum("times").alias("beside")).where(F.col("instances") >= LEAST_SUPPORT), "candidates"
    )
    wordy = candidates.where(of_words(F.col("pattern"))).select("pattern", "beside")
    words = docs.select(F.regexp_extract_all(F.lower(empty_text(text_col)), F.lit(WORD), F.lit(0)).alias("w"))
    pairs = words.select(F.inline(F.arrays_zip(F.col("w").alias("word"), F.slice("w", F.lit(2), F.size("w")).alias("next"))))
    written = F.array(
        F.concat("word", F.lit(" _")), F.concat(F.lit("_ "), "word"), F.concat_ws(" ", "word", "next", F.when(F.col("next").isNotNull(), F.lit("_"))),
    )
    if wordy.count() <= SMALL_TABLE:
        # Only words that begin a candidate are spelled out as patterns.
        after = ~F.col("pattern").endswith(" _")
        begins = wordy.select(F.when(after, F.substring("pattern", 3, 1 << 30)).otherwise(F.substring_index("pattern", " ", 1)).alias("word")).distinct()
        pairs = pairs.join(F.broadcast(begins), "word", "left_semi")
        every = pairs.select(F.explode(written).alias("pattern")).join(F.broadcast(wordy.select("pattern")), "pattern", "left_semi")
    else:
        every = pairs.select(F.explode(written).alias("pattern"))
    counted = every.groupBy("pattern").agg(F.count("*").alias("occurring")).join(wordy, "pattern")
    specific = counted.where(F.col("beside") >= SPECIFIC * F.col("occurring")).select("pattern")
    return specific.unionByName(candidates.where(~of_words(F.col("pattern"))).select("pattern"))


def score_patterns(links: DataFrame, believed: DataFrame) -> DataFrame:
    """``(pattern, score, support)`` of patterns that pass, given ``(instance, belief)``."""
    weighed = links.join(believed, "instance", "left").select("pattern", F.coalesce("belief", F.lit(0.0)).alias("belief"))
    scored = weighed.groupBy("pattern").agg(
        F.avg("belief").alias("score"), F.count_if(F.col("belief") >= CONFIDENCE).alias("support")
    )
    return scored.where((F.col("support") >= LEAST_SUPPORT) & (F.col("score") >= CONFIDENCE))


def passed_patterns(found: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(pattern)``: the patterns of high confidence, stored."""
    graph = store(pattern_graph(found), "graph")
    links = store(graph.join(announcing_patterns(graph, docs), "pattern").drop("times"), "links")
    seeds = links.where("seed").select("instance").distinct().withColumn("belief", F.lit(1.0))
    believed, accepted, tables = seeds, links.limit(0), []
    for _ in range(rounds):
        accepted = store(score_patterns(links, believed), "patterns")
        # Patterns of one place are no independent witnesses, so the best of them counts.
        derived = links.where(~F.col("seed")).join(accepted, "pattern").groupBy("instance").agg(F.max("score").alias("belief"))
        done = tables
        believed = store(seeds.unionByName(derived.join(seeds.select("instance"), "instance", "left_anti")), "believed")
        tables = [accepted, believed]
        discard(*done)
    return accepted.select("pattern")


def bootstrap(found: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> list[str]:
    """The patterns of high confidence in order, on the driver."""
    return [row["pattern"] for row in passed_patterns(found, docs, rounds).orderBy("pattern").collect()]


def judge(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)``; spans by kind, then start.
    ``found`` also has ``row``, a number of its own for each row: ids may repeat or be null."""
    base = [as_spans(F.col(kind), kind) for kind in KINDS]
    tokens = found.select("row", F.explode("tokens").alias("m")).select("row", "m.start", "m.end", F.explode(patterns_of(F.col("m"))).alias("pattern"))
    announced = tokens.join(patterns, "pattern", "left_semi").groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("context"))
    extra = F.coalesce(as_spans(F.col("context"), "context"), F.array().cast(SPAN))
    return found.drop("tokens").join(announced, "row", "left").select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.concat(*base).alias("base"), F.concat(*base, extra).alias("spans"),
    )


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)`` for every document."""
    found = store(scan(docs).withColumn("row", F.monotonically_increasing_id()), "personal")
    return judge(found, passed_patterns(found, docs, rounds))


def digests(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", *[f"n_{kind}" for kind in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def redact_personal_data(docs: DataFrame, patterns: list[str], mark: str = "[PRIVATE]") -> DataFrame:
    """``docs`` with the spans of its texts replaced; patterns come from ``bootstrap``."""
    text, columns = empty_text(), docs.columns
    kinds = base_matches(text)
    held = docs.withColumns({f"__{kind}": found for kind, found in kinds.items()} | {"__tokens": _trimmed(matches(text, TOKEN, text.rlike("[0-9@]"), around=True))})
    wanted = F.filter("__tokens", lambda m: F.arrays_overlap(F.lit(patterns or ["\n"]), patterns_of(m)))
    spans = reduce(F.concat, [as_spans(F.col(f"__{kind}"), kind) for kind in KINDS] + [as_spans(wanted, "context")])
    held = held.withColumn("__spans", spans)
    changed = F.when(F.col("text").isNotNull(), redact(text, F.col("__spans"), mark))
    return held.select(*[changed.alias(c) if c == "text" else F.col(c) for c in columns])
