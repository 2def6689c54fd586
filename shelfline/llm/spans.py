"""Places of pattern matches in texts, as SQL expressions.

Spark returns what a pattern matches but not where. The pieces between the matches come from
``split`` with the same pattern, and the lengths of pieces and matches add up to the places, in
code points. Patterns are written so that they neither backtrack nor recurse over long runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
# The word after a match; what ends a sentence or a clause right behind the match is passed over.
NEXT_WORD = r"^[\"')\]}>.,;:!?]*+[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)"
BLANKS = " \t\n\x0b\x0c\r"  # the characters of the class BLANK
MATCH = "array<struct<start:int,end:int,value:string>>"
AROUND = "array<struct<start:int,end:int,value:string,left:string,left2:string,right:string>>"  # with the words around
PAIR = "array<struct<at:int,gap:string,value:string,right:string>>"
SPAN = "array<struct<kind:string,start:int,end:int>>"


def _running(pairs: Column) -> Column:
    """``array<struct<at,gap,value,right>>`` with the place of each pair's gap. Places are summed in
    blocks, so the work stays near linear in the number of matches."""

    def at(x: Column, place: Column) -> Column:
        return F.struct(place.alias("at"), x["gap"].alias("gap"), x["value"].alias("value"), x["right"].alias("right"))

    def block(start: Column) -> Column:
        def add(state: Column, x: Column) -> Column:
            return F.struct(
                (state["n"] + F.length(x["gap"]) + F.length(x["value"])).alias("n"),
                F.concat(state["found"], F.array(at(x, state["n"]))).alias("found"),
            )

        empty = F.struct(F.lit(0).alias("n"), F.array().cast(PAIR).alias("found"))
        return F.aggregate(F.slice(pairs, start, F.lit(BLOCK)), empty, add)

    def shifted(blocks: Column) -> Column:
        # One start per block: few enough to be added up in an array that grows.
        starts = F.aggregate(
            blocks, F.array(F.lit(0)), lambda starts, x: F.concat(starts, F.array(F.element_at(starts, -1) + x["n"]))
        )
        return F.flatten(F.zip_with(
            blocks, F.slice(starts, F.lit(1), F.size(blocks)), lambda x, start: F.transform(x["found"], lambda m: at(m, m["at"] + start))
        ))

    return _bind(F.transform(F.sequence(F.lit(1), F.size(pairs), F.lit(BLOCK)), block), shifted)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda's variable is not expanded again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_before(piece: Column, at: Column, original: Column | None = None) -> Column:
    """``left`` and ``left2``: the lower-cased word that ends a piece of text, if blanks part it from
    what follows, and the two words that end it, if one blank parts them. A piece that starts at
    ``at`` may have ``_`` for characters of ``original``, but keeps its blanks; such words are taken
    from ``original`` by their place."""

    def spaced(text: Column) -> Column:
        return F.translate(text, BLANKS, " " * len(BLANKS))

    def ending(trimmed: Column) -> Column:
        two = F.substring_index(spaced(trimmed), " ", -2)
        if original is not None:
            two = _bind(two, lambda word: F.when(word.contains("_"), spaced(
                F.substring(original, at + F.length(trimmed) - F.length(word) + 1, F.length(word))
            )).otherwise(word))
        return F.when(F.length(trimmed) < F.length(piece), F.lower(two)).otherwise("")

    def both(two: Column) -> Column:
        whole = two.contains(" ") & ~two.startswith(" ")
        return F.struct(F.substring_index(two, " ", -1).alias("left"), F.when(whole, two).otherwise("").alias("left2"))

    return _bind(_bind(F.rtrim(piece, F.lit(BLANKS)), ending), both)


def matches(
    text: Column, pattern: str, guard: Column | None = None, original: Column | None = None, around: bool = False
) -> Column:
    """All matches of ``pattern``, leftmost first and not overlapping, with ``start``, ``end``
    (exclusive) and ``value``. With ``around`` also ``left`` and ``left2``, the word and the two
    words before, and ``right``, the word after; words are looked for up to the next match.
    ``guard`` is a cheap test that texts with a match pass; ``original`` is what ``text`` was before
    characters were replaced by ``_``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = found if guard is None else F.when(guard, found).otherwise(F.array().cast("array<string>"))

    def place(values: Column) -> Column:
        def paired(pieces: Column) -> Column:
            gaps = F.slice(pieces, F.lit(1), F.size(values))
            if not around:
                return F.zip_with(gaps, values, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"), F.lit("").alias("right")))
            after = F.transform(F.slice(pieces, F.lit(2), F.size(values)), lambda gap: F.lower(F.regexp_extract(gap, NEXT_WORD, 1)))
            return F.transform(F.arrays_zip(gaps.alias("gap"), values.alias("value"), after.alias("right")), lambda x: F.struct(
                x["gap"].alias("gap"), x["value"].alias("value"), x["right"].alias("right")
            ))

        def placed(m: Column) -> Column:
            start = m["at"] + F.length(m["gap"])
            columns = [start.alias("start"), (start + F.length(m["value"])).alias("end"), m["value"].alias("value")]
            if not around:
                return F.struct(*columns)
            return _bind(words_before(m["gap"], m["at"], original), lambda w: F.struct(
                *columns, w["left"].alias("left"), w["left2"].alias("left2"), m["right"].alias("right")
            ))

        placed = F.transform(_bind(_bind(F.split(text, pattern, -1), paired), _running), placed)
        return F.when(F.size(values) > 0, placed).otherwise(F.array().cast(AROUND if around else MATCH))

    return _bind(found, place)


def as_spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the order given."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def outside(found: Column, *kinds: Column) -> Column:
    """The matches that overlap no span of ``kinds``. The spans of a kind are in order and do not
    overlap, so of each kind only the last one that starts before a match ends can: it is found by
    binary search, and the work stays near linear in the number of matches."""

    def last_before(spans: Column, steps: Column, end: Column) -> Column:
        """How many spans start before ``end``."""
        return F.aggregate(
            steps, F.lit(0), lambda at, step: F.when(F.get(spans, at + step - 1)["start"] < end, at + step).otherwise(at)
        )

    def clear_of(spans: Column, found: Column) -> Column:
        # Powers of two from the largest within the number of spans down to one.
        powers = F.filter(F.array(*[F.lit(1 << bit) for bit in reversed(range(30))]), lambda p: p <= F.size(spans))

        def judged(steps: Column) -> Column:
            return F.filter(found, lambda m: ~F.coalesce(F.get(spans, last_before(spans, steps, m["end"]) - 1)["end"] > m["start"], F.lit(False)))

        return F.when(F.size(spans) > 0, _bind(powers, judged)).otherwise(found)

    for kind in kinds:
        found = _bind(F.struct(kind.alias("spans"), found.alias("found")), lambda x: clear_of(x["spans"], x["found"]))
    return found


def redact(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every stretch covered by spans replaced by ``mark``."""

    def add(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        piece = F.concat(F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"),
        )

    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    written = F.aggregate(ordered, start, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, written).otherwise(text)
