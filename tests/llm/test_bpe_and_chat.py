"""Byte-pair encoding against the tokenizers library; chat formatting by exact round trips."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_data import no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from shelfline.llm import bpe, chat, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary(PATH))


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


TEXTS = [
    "", " \n\t", "Hello, World's best 123!", "a<|endoftext|>b<|startoftext|>", "<|endoftext", "ΣΑΣ Σ", "İstanbul ß ﬁ é é", "a\x1cb \x1f c",
    "x\x85y\xa0z　w", "​ ﻿", "漢字かな 한국어", "😀😀", "I'LL we've 'S", "½²Ⅷ", "a" * 63, "a" * 64, "a" * 65, "the" * 900, "!?" * 900, "漢字" * 300,
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_and_decoding(codec, reference, text):
    expected = reference.encode(text, add_special_tokens=False).ids
    assert ids(codec, text) == expected
    assert codec.decode(codec.encode(text)) == reference.decode(expected, skip_special_tokens=False)


def test_random_texts(codec, reference):
    r = random.Random(4)
    pool = list("abcdeXYZ'stre ΣςéÉñ\n\t.,!0123456789²<|>") + ["<|endoftext|>", "\x1c", "\x85", "漢", "😀", "'re", "'LL", "ﬁ", "the", "ing"]
    texts = ["".join(r.choices(pool, k=r.randrange(60))) for _ in range(3000)]
    for text, made in zip(texts, codec.encode_many(texts), strict=True):
        assert np.frombuffer(made, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, text


def test_full_tables_start_over(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 1000)
    for text in ("some words here", "and others there", "some words here again"):
        assert ids(codec, text) == reference.encode(text, add_special_tokens=False).ids


def test_tables_stay_within_their_bytes(codec):
    """Chunks of 64 thousand letters leave nothing behind, short ones no more than the stated bytes and
    what one call adds."""
    r = random.Random(1)
    codec._empty_tables()
    for _ in range(3):
        codec.encode(" ".join("".join(r.choices("abcdefgh", k=1 << 16)) for _ in range(2)))
    assert max(map(len, codec.chunks), default=0) <= bpe.KEPT_CHARS and len(codec.chunks) < 10
    assert codec.kept_bytes < 10_000


def test_many_special_tokens_in_a_row(codec, reference):
    import time

    text = "<|endoftext|>" * 100_000 + "a<|startoftext|>b<|" * 1000
    start = time.time()
    made = ids(codec, text)
    assert time.time() - start < 3 and made == reference.encode(text, add_special_tokens=False).ids


def test_one_long_word(codec, reference):
    import time

    word = "".join(random.Random(2).choices("etaoinshrdlu", k=300_000))
    start = time.time()
    made = ids(codec, word)
    assert time.time() - start < 6 and made == reference.encode(word, add_special_tokens=False).ids


def test_blocks_do_not_change_ids(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 7)
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choices(["ab", "C", " ", "\n", "\u3000", "<|endoftext|>", ".", "\x1c", "é"], k=r.randrange(30)))
        assert ids(codec, text) == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_query_equals_the_library(spark, reference):
    docs = {x.doc_id: x.text or "" for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = queries.op4_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(docs)
    for x in found:
        expected = reference.encode(docs[x.doc_id], add_special_tokens=False).ids
        decoded = reference.decode(expected, skip_special_tokens=False)
        assert x.n_tokens == len(expected)
        assert x.ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encoding_odd_rows(odd_docs, no_docs):
    encoded = bpe.encode_documents(odd_docs, PATH)
    assert encoded.count() == odd_docs.count()
    assert [len(x.ids) for x in encoded.where("doc_id <= 3").collect()] == [0, 0, 0]
    assert bpe.decode_documents(encoded, PATH).count() == odd_docs.count()
    assert bpe.encoding_digests(odd_docs, PATH).count() == odd_docs.count()
    assert bpe.encoding_digests(no_docs, PATH).count() == 0


# ---- chat -----------------------------------------------------------------------------------

PIECES = ["<", "/", "s", ">", "[", "]", "INST", "\\", "|", "end", "text", " ", "\n", "a", "é", "\\<", *chat.CONTROLS]


def test_escape_is_reversible_and_harmless():
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choices(PIECES, k=r.randrange(12)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROLS)


def test_turns_are_read_back():
    r, render = random.Random(2), chat.compile_template(chat.TEMPLATE)
    for _ in range(2000):
        turns = [
            {"role": r.choice(["user", "assistant", "system", "tool", "", "[INST]"]), "text": "".join(r.choices(PIECES, k=r.randrange(9)))}
            for _ in range(r.randrange(5))
        ]
        reader, found, learned = chat.TurnReader(), [], []
        for text, generated in render({"turns": iter(turns)}):
            found += reader.feed(text)
            learned += [chat.unescape(text)] if generated else []
        assert found == [(t["role"], t["text"]) for t in turns] and not reader.rest
        assert learned == [t["text"] for t in turns if t["role"] == "assistant"]


def test_constants_are_folded():
    tree = chat.fold(chat.parse("{% if 1 == 1 %}a{{ 'b' + 'c' | upper }}{% else %}{{ x }}{% endif %}d{# no #}{{ 'e' }}"))
    assert tree == ("body", [("output", ("const", "abCde"))])


def test_templates_reach_their_data_only():
    render = chat.compile_template("{{ x.__class__ }}{{ missing }}{% for t in x.items %}{{ t.n + 1 }};{% endfor %}{{ not x.n and 'y' }}")
    assert "".join(t for t, _ in render({"x": {"items": [{"n": 1}, {"n": 2}]}})) == "2;3;y"


@pytest.mark.parametrize("source", ["{% for x y %}", "{% if a %}", "{{ a b }}", "{{ a | nope }}", "{% endfor %}", "{{ 'x }}", "{% import os %}", "{{ a() }}"])
def test_mistakes_are_reported(source):
    with pytest.raises(chat.TemplateError):
        chat.parse(source)


def test_chat_query_equals_brute_force(spark):
    found = {x.conv_id: x for x in queries.op1_chat(spark, "/root/testdata/sf0.001").collect()}
    turns = defaultdict(list)
    for x in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect():
        turns[x.conv_id].append((x.turn, x.role, x.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(found) == set(turns)
    for key, rows in turns.items():
        said = sorted(rows)
        learned = "".join(t for _, role, t in said if role == "assistant")
        x = found[key]
        assert (x.n_turns, x.loss_chars) == (len(said), len(learned))
        assert x.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in said).encode()).hexdigest()
        assert x.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_odd_rows(spark):
    rows = [
        (1, None, None, None, 1), (1, 0, "assistant", None, 2), (1, 0, "assistant", "b", 3), (1, 0, "assistant", "b", 4), (None, 1, "user", "", 5),
        (2, 0, "assistant", "long " * 60_000, 6), (2, 1, "assistant", "\\" * 5, 7),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted long")
    parts = chat.format_conversations(turns)
    assert parts.where("conv_id = 2").count() > 1
    found = {x.conv_id: x for x in chat.read_digests(parts).collect()}
    assert {k: (x.n_turns, x.loss_chars) for k, x in found.items()} == {1: (4, 2), None: (1, 0), 2: (2, 300_005)}
    assert chat.read_digests(chat.format_conversations(turns.limit(0))).count() == 0
