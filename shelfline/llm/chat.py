"""Chat formatting: a small sandboxed template language, compiled to Python closures.

    {{ expression }}                      output
    {% for name in expression %}...{% endfor %}
    {% if test %}...{% elif test %}...{% else %}...{% endif %}
    {% generation %}...{% endgeneration %}   marks what a model is trained to write
    {# comment #}

Expressions have strings, integers, names, ``name.attribute``, ``+``, ``==``, ``!=``, ``and``,
``or``, ``not``, parentheses and the filters ``escape``, ``trim``, ``upper`` and ``lower``.
Attributes are looked up in dictionaries only, so a template reaches nothing but its own data. A
minus inside a tag (``{%-``, ``-%}``) strips the blanks beside it.

Source is parsed into a syntax tree of tuples, constant parts are folded (adjacent text is joined,
tests with a known result keep one branch), and each node becomes a closure that yields
``(text, is_generated)`` pieces. A loop draws its items as it goes, so a conversation of any length
is rendered with one turn in memory.

``escape`` makes control strings inside texts harmless: every backslash is doubled, and a single
backslash goes in after the first character of every control string. ``unescape`` undoes both.

Rows are ordered by turn (nulls first), then role and text, so repeated turns have one order. A
null text or role counts as empty. Turns without a conversation id form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import pieces

Piece = tuple[str, bool]

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>")

TEMPLATE = """
{%- for turn in turns -%}
{%- if turn.role == 'user' -%}
{{ '<s>' + '[INST] ' }}{{ turn.text | escape }}{{ ' [/INST]' }}
{%- elif turn.role == 'assistant' -%}
{{ ' ' }}{% generation %}{{ turn.text | escape }}{% endgeneration %}{{ ' </s>' }}
{%- elif turn.role == 'system' -%}
{{ '<<SYS>>\n' }}{{ turn.text | escape }}{{ '\n<</SYS>>' }}
{%- else -%}
{{ '<|role|>' }}{{ turn.role | escape }}{{ '<|text|>' }}{{ turn.text | escape }}{{ '<|end|>' }}
{%- endif -%}
{%- endfor -%}
"""


class TemplateError(ValueError):
    """The template does not follow the language."""


# ---- escaping -------------------------------------------------------------------------------


@cache
def _control_heads(controls: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls))


def escape(text: str, controls: tuple[str, ...] = CONTROLS) -> str:
    return _control_heads(controls).sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


# ---- source to syntax tree ------------------------------------------------------------------

TAG = re.compile(r"\{(?P<kind>[{%#])(?P<left>-?)(?P<body>.*?)(?P<right>-?)[}%#]\}", re.DOTALL)
TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[().|+]))")
FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
CLOSING = {"{": "}}", "%": "%}", "#": "#}"}


def _pieces(source: str) -> list[tuple[str, str]]:
    """``(kind, content)`` with kinds ``text``, ``{`` and ``%``; comments are gone."""
    found, start, strip = [], 0, False
    for tag in TAG.finditer(source):
        if not tag.group().endswith(CLOSING[tag["kind"]]):
            raise TemplateError(f"unclosed tag {tag.group()[:40]!r}")
        text = source[start : tag.start()]
        text = text.lstrip() if strip else text
        found.append(("text", text.rstrip() if tag["left"] else text))
        if tag["kind"] != "#":
            found.append((tag["kind"], tag["body"].strip()))
        start, strip = tag.end(), bool(tag["right"])
    rest = source[start:]
    return [*found, ("text", rest.lstrip() if strip else rest)]


class _Expression:
    """Recursive descent, loosest first: or, and, not, comparison, sum, filter, value."""

    def __init__(self, source: str):
        self.tokens, place, source = [], 0, source.rstrip()
        while place < len(source):
            token = TOKEN.match(source, place)
            if not token:
                raise TemplateError(f"cannot read {source[place:place + 20]!r}")
            self.tokens.append((token.lastgroup, token[token.lastgroup]))
            place = token.end()
        self.tokens.append(("end", ""))

    def parse(self) -> tuple:
        tree = self._either()
        if self.tokens[0][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return tree

    def _take(self, *values: str) -> str | None:
        kind, value = self.tokens[0]
        if kind in ("mark", "name") and value in values:
            self.tokens.pop(0)
            return value
        return None

    def _left_to_right(self, part: Callable[[], tuple], *operators: str) -> tuple:
        tree = part()
        while operator := self._take(*operators):
            tree = (operator, tree, part())
        return tree

    def _either(self) -> tuple:
        return self._left_to_right(self._both, "or")

    def _both(self) -> tuple:
        return self._left_to_right(self._negated, "and")

    def _negated(self) -> tuple:
        return ("not", self._negated()) if self._take("not") else self._left_to_right(self._sum, "==", "!=")

    def _sum(self) -> tuple:
        return self._left_to_right(self._filtered, "+")

    def _filtered(self) -> tuple:
        tree = self._value()
        while self._take("|"):
            kind, name = self.tokens.pop(0)
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def _value(self) -> tuple:
        kind, value = self.tokens.pop(0)
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return ("const", int(value))
        if (kind, value) == ("mark", "("):
            tree = self._either()
            if not self._take(")"):
                raise TemplateError("missing )")
            return tree
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        tree = ("const", value == "true") if value in ("true", "false") else ("name", value)
        while self._take("."):
            kind, value = self.tokens.pop(0)
            if kind != "name":
                raise TemplateError("an attribute needs a name")
            tree = ("attribute", tree, value)
        return tree


def parse(source: str) -> tuple:
    """The syntax tree: ``("body", nodes)`` of text, output, for, if and generation nodes."""
    pieces = _pieces(source)

    def body(*ends: str) -> tuple[tuple, str]:
        nodes = []
        while pieces:
            kind, content = pieces.pop(0)
            if kind == "text":
                nodes.append(("output", ("const", content)))
            elif kind == "{":
                nodes.append(("output", _Expression(content).parse()))
            else:
                word, _, rest = content.partition(" ")
                if word in ends:
                    return ("body", nodes), content
                nodes.append(block(word, rest.strip()))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("body", nodes), ""

    def block(word: str, rest: str) -> tuple:
        if word == "for" and (head := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)):
            return ("for", head[1], _Expression(head[2]).parse(), body("endfor")[0])
        if word == "generation" and not rest:
            return ("generation", body("endgeneration")[0])
        if word == "if":
            then, end = body("elif", "else", "endif")
            test = _Expression(rest).parse()
            if end.startswith("elif"):
                return ("if", test, then, block("if", end.partition(" ")[2].strip()))
            return ("if", test, then, body("endif")[0] if end == "else" else ("body", []))
        raise TemplateError(f"unknown tag {word!r}")

    return body()[0]


# ---- constant folding -----------------------------------------------------------------------


def _apply(operator: str, *values):
    if operator == "+":
        return str(values[0]) + str(values[1]) if isinstance(values[0], str) or isinstance(values[1], str) else values[0] + values[1]
    if operator in ("==", "!="):
        return (values[0] == values[1]) == (operator == "==")
    if operator == "and":
        return values[0] and values[1]
    return values[0] or values[1] if operator == "or" else not values[0]


def fold(node: tuple) -> tuple:
    """The same tree with everything computed that does not depend on the data."""
    kind = node[0]
    if kind in ("+", "==", "!=", "and", "or", "not"):
        parts = [fold(n) for n in node[1:]]
        if all(p[0] == "const" for p in parts):
            return ("const", _apply(kind, *(p[1] for p in parts)))
        return (kind, *parts)
    if kind == "filter":
        inner = fold(node[2])
        return ("const", FILTERS[node[1]](str(inner[1]))) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "attribute":
        return ("attribute", fold(node[1]), node[2])
    if kind == "output":
        return ("output", fold(node[1]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "if":
        test = fold(node[1])
        if test[0] == "const":
            return fold(node[2] if test[1] else node[3])
        return ("if", test, fold(node[2]), fold(node[3]))
    if kind == "body":
        nodes: list[tuple] = []
        for child in map(fold, node[1]):
            for n in child[1] if child[0] == "body" else [child]:
                constant = n[0] == "output" and n[1][0] == "const"
                if constant and n[1][1] == "":
                    continue
                if constant and nodes and nodes[-1][0] == "output" and nodes[-1][1][0] == "const":
                    nodes[-1] = ("output", ("const", str(nodes[-1][1][1]) + str(n[1][1])))
                else:
                    nodes.append(n)
        return ("body", nodes)
    return node


# ---- closures -------------------------------------------------------------------------------


def _value(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        constant = node[1]
        return lambda data: constant
    if kind == "name":
        name = node[1]
        return lambda data: data.get(name, "")
    if kind == "attribute":
        owner, key = _value(node[1]), node[2]

        def attribute(data: dict):
            held = owner(data)
            return held.get(key, "") if isinstance(held, dict) else ""

        return attribute
    if kind == "filter":
        change, inner = FILTERS[node[1]], _value(node[2])
        return lambda data: change(str(inner(data)))
    parts = [_value(n) for n in node[1:]]
    return lambda data: _apply(kind, *(part(data) for part in parts))


def _writer(node: tuple) -> Callable[[dict, bool], Iterator[Piece]]:
    kind = node[0]
    if kind == "output":
        value = _value(node[1])

        def output(data: dict, generated: bool) -> Iterator[Piece]:
            yield str(value(data)), generated

        return output
    if kind == "for":
        name, items, inside = node[1], _value(node[2]), _writer(node[3])

        def loop(data: dict, generated: bool) -> Iterator[Piece]:
            for item in items(data):
                yield from inside({**data, name: item}, generated)

        return loop
    if kind == "generation":
        marked = _writer(node[1])
        return lambda data, generated: marked(data, True)
    if kind == "if":
        test, then, other = _value(node[1]), _writer(node[2]), _writer(node[3])
        return lambda data, generated: (then if test(data) else other)(data, generated)
    writers = [_writer(n) for n in node[1]]

    def body(data: dict, generated: bool) -> Iterator[Piece]:
        for writer in writers:
            yield from writer(data, generated)

    return body


@cache
def compile_template(source: str) -> Callable[[dict], Iterator[Piece]]:
    """A function from the template's data to its pieces ``(text, is_generated)``."""
    write = _writer(fold(parse(source)))
    return lambda data: write(data, False)


# ---- reading back ---------------------------------------------------------------------------

# One turn as the default template writes it. The texts hold no control string, so the first one
# met is the template's own.
TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>>\n(?P<system>.*?)\n<</SYS>>"
    r"|<\|role\|>(?P<role>.*?)<\|text\|>(?P<text>.*?)<\|end\|>| (?P<assistant>.*?) </s>",
    re.DOTALL,
)


class TurnReader:
    """Reads turns from formatted text that arrives in parts; keeps only an unfinished turn."""

    def __init__(self):
        self.rest = ""

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self.rest += text
        place = 0
        while turn := TURN.match(self.rest, place):
            place = turn.end()
            if turn["role"] is not None:
                yield unescape(turn["role"]), unescape(turn["text"])
            else:
                role = next(r for r in ("user", "system", "assistant") if turn[r] is not None)
                yield role, unescape(turn[role])
        self.rest = self.rest[place:]


# ---- Spark ----------------------------------------------------------------------------------

PART_CHARS = 1 << 16


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in pieces(batches):
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``(conv_id, part, formatted, spans)``: each conversation as one or more parts in order;
    ``spans`` are the ``start:end`` places in the part (code points, comma-joined) under the loss
    mask. Parts end between pieces, at about 64 thousand characters, so a conversation of any
    length is streamed; parts of a conversation follow each other in one task."""
    compile_template(template)  # report mistakes before a job starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, rows = compile_template(template), _rows(batches)
        made: list[tuple] = []
        ahead = next(rows, None)
        while ahead is not None:
            key, done = ahead[0], False

            def of_conversation() -> Iterator[dict]:
                nonlocal ahead, done
                while ahead is not None and ahead[0] == key:
                    _, role, text = ahead
                    ahead = next(rows, None)
                    yield {"role": role or "", "text": text or ""}
                done = True

            part, texts, spans, size = 0, [], [], 0
            for text, generated in render({"turns": of_conversation(), "conv_id": key}):
                texts.append(text)
                if generated:
                    spans.append(f"{size}:{size + len(text)}")
                size += len(text)
                if size >= PART_CHARS:
                    made.append((key, part, "".join(texts), ",".join(spans)))
                    part, texts, spans, size = part + 1, [], [], 0
                if len(made) >= 64:
                    yield _batch(made)
                    made = []
            made.append((key, part, "".join(texts), ",".join(spans)))
            if not done:  # a template without a loop over the turns
                for _ in of_conversation():
                    pass
        if made:
            yield _batch(made)

    def _batch(made: list[tuple]) -> pa.RecordBatch:
        keys, parts, texts, spans = zip(*made, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(parts, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, pa.string())],
            ["conv_id", "part", "formatted", "spans"],
        )

    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions(*order)
    return ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, part long, formatted string, spans string")


def read_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted text says, read back part by part:
    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        state = None

        def close() -> None:
            if state is not None:
                key, reader, turns, turn_hash, loss, loss_hash, size = state
                if reader.rest:
                    raise ValueError(f"conversation {key} ends within a turn")
                made.append((key, turns, turn_hash.hexdigest(), loss, loss_hash.hexdigest(), size))

        for key, part, text, spans in _rows(batches):
            if part == 0:
                close()
                state = [key, TurnReader(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in state[1].feed(text):
                state[2] += 1
                state[3].update(f"{role}\n{said}\n".encode())
            for span in filter(None, spans.split(",")):
                start, end = map(int, span.split(":"))
                learned = unescape(text[start:end])
                state[4] += len(learned)
                state[5].update(learned.encode())
            state[6] += len(text)
            if len(made) >= 512:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made, strict=True), kinds, strict=True)], names)
                made = []
        close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)
