"""Byte-pair encoding and decoding with a public vocabulary file.

A word is held as two contiguous arrays: the ids of its parts, and the rank of each pair of
neighbouring parts. The smallest rank is found by a scan, the boundary at that place is deleted,
and only the two ranks beside it are looked up again. Words of equal length take these steps
together: each loses one boundary per step, so their arrays stay the rows of one matrix. The scan
is quick for short words; a word of more than ``LONG_WORD`` bytes keeps its candidate pairs in a
heap instead, with the same result (lowest rank first, then leftmost).

Vocabularies are read from the path given, on the driver, and go to the tasks with the function.
Words never span white space, so encoded chunks of text between white space are kept in a table per
Python worker: short chunks only, up to ``KEPT_BYTES`` in all. Very long texts are encoded in
blocks that end at white space. Nulls: a null text is empty and gives no ids; null or repeated
document ids keep their rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.text import map_columns, map_rows

LONG_WORD = 64
KEPT_CHARS = 64  # longer chunks and words are encoded each time
KEPT_BYTES = 192 << 20
ENTRY_BYTES = 240  # of a table's entry beside what it says
BLOCK_CHARS = 1 << 20
NO_RANK = 1 << 30

# Unicode white space. str.split() also cuts at the four separators \x1c-\x1f, which are no white
# space here, so texts that have them take the regular expression.
SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
SPACES = re.compile(f"[{SPACE}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, spare = [], 0x100
    for byte in range(256):
        if byte in printable:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(spare))
            spare += 1
    return symbols


@lru_cache(maxsize=2)
def category_ranges(major: str) -> str:
    """The characters of a major Unicode category, as the inside of a character class."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return "".join(f"{run[0]}-{run[-1]}" for run in regex.findall(rf"\p{{{major}}}+", everything))


class Vocabulary:
    """A word-end BPE vocabulary: ids, merge ranks, and the pattern that cuts text into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, ids = spec["model"], spec["model"]["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, number in [*ids.items(), *self.special.items()]:
            self.tokens[number] = token
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        for name, inside in ((r"\p{L}", category_ranges("L")), (r"\p{N}", category_ranges("N")), (r"\s", SPACE)):
            pattern = pattern.replace(f"[{name}]", f"[{inside}]").replace(name, inside)
        self.word_pattern = pattern
        symbols = byte_symbols()
        self.inner = [ids[s] for s in symbols]
        self.last = [ids[s + self.end] for s in symbols]
        # (left id, right id) packed in one number, in order, and the rank of each pair; the rank
        # gives the merged part
        packed = np.array([(ids[a] << 20) | ids[b] for a, b in model["merges"]], np.int64)
        order = np.argsort(packed)
        self.pairs, self.pair_ranks = packed[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in model["merges"]], np.int32)
        self._table = None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        packed = (left.astype(np.int64) << 20) | right
        at = np.searchsorted(self.pairs, packed).clip(max=len(self.pairs) - 1)
        return np.where(self.pairs[at] == packed, self.pair_ranks[at], NO_RANK)


    def pair_table(self) -> tuple[dict[tuple[int, int], int], list[int]]:
        """Ranks by pair, and merged parts by rank, as plain objects: made once, when first used."""
        if self._table is None:
            left, right = (self.pairs >> 20).tolist(), (self.pairs & ((1 << 20) - 1)).tolist()
            self._table = dict(zip(zip(left, right, strict=True), self.pair_ranks.tolist(), strict=True)), self.merged.tolist()
        return self._table


def merge_short(parts: np.ndarray, vocabulary: Vocabulary) -> list[bytes]:
    """Ids of words of equal length, one row each. Every step scans the rank arrays for their
    minima, deletes one boundary per row and refreshes the ranks on both sides of it; rows
    without a pair that merges are done and leave."""
    done: list[bytes] = [b""] * len(parts)
    rows, ranks = np.arange(len(parts)), vocabulary.ranks(parts[:, :-1], parts[:, 1:])
    while len(rows):
        width = parts.shape[1]
        at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)  # leftmost minimum
        lowest = ranks[np.arange(len(rows)), at] if width > 1 else np.full(len(rows), NO_RANK)
        going = lowest < NO_RANK
        if not going.all():
            stopped = ~going
            for row, ids in zip(rows[stopped].tolist(), np.ascontiguousarray(parts[stopped], "<u4"), strict=True):
                done[row] = ids.tobytes()
            rows, parts, ranks, at, lowest = rows[going], parts[going], ranks[going], at[going], lowest[going]
            if not len(rows):
                break
        line = np.arange(len(rows))
        parts[line, at] = vocabulary.merged[lowest]
        keep = np.ones(parts.shape, bool)
        keep[line, at + 1] = False
        parts = parts[keep].reshape(len(rows), width - 1)
        keep = np.ones(ranks.shape, bool)
        keep[line, at] = False
        ranks = ranks[keep].reshape(len(rows), width - 2)
        before = at > 0
        ranks[line[before], at[before] - 1] = vocabulary.ranks(parts[line[before], at[before] - 1], parts[line[before], at[before]])
        after = at < width - 2
        ranks[line[after], at[after]] = vocabulary.ranks(parts[line[after], at[after]], parts[line[after], at[after] + 1])
    return done


def merge_long(parts: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same merges with a heap of (rank, place) and links to the neighbouring parts."""
    n = len(parts)
    left, right, alive = [*range(-1, n - 1)], [*range(1, n + 1)], [True] * n
    rank_of, merged = vocabulary.pair_table()
    heap = [(rank_of[pair], i, *pair) for i, pair in enumerate(zip(parts, parts[1:], strict=False)) if pair in rank_of]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = right[i]
        if j < n and (rank := rank_of.get((parts[i], parts[j]))) is not None:
            heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = right[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j], right[i] = merged[rank], False, right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    return [p for p, kept in zip(parts, alive, strict=True) if kept]


def blocks_of(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """A text in blocks of about ``size`` characters that end before white space."""
    start = 0
    while start < len(text):
        cut = SPACES.search(text, start + size) if len(text) - start > size else None
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop


class Codec:
    """Encoder and decoder of one Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cut = re.compile(vocabulary.word_pattern).findall
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or r"(?!)")
        self.inner, self.last = np.array(vocabulary.inner, np.int32), np.array(vocabulary.last, np.int32)
        self._empty_tables()

    def _empty_tables(self) -> None:
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {name: np.array([number], "<u4").tobytes() for name, number in self.vocabulary.special.items()}
        self.kept_bytes = 0

    def _keep(self, table: dict[str, bytes], made: dict[str, bytes]) -> None:
        short = {text: ids for text, ids in made.items() if len(text) <= KEPT_CHARS}
        table.update(short)
        self.kept_bytes += sum(ENTRY_BYTES + 4 * len(text) + len(ids) for text, ids in short.items())

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, all of a length together."""
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word.encode()), []).append(word)
        made: dict[str, bytes] = {}
        for length, same in by_length.items():
            raw = np.frombuffer("".join(same).encode(), np.uint8).reshape(len(same), length)
            parts = self.inner[raw]
            parts[:, -1] = self.last[raw[:, -1]]
            if length <= LONG_WORD:
                ids = merge_short(parts, self.vocabulary)
            else:
                ids = [np.array(merge_long(row.tolist(), self.vocabulary), "<u4").tobytes() for row in parts]
            made.update(zip(same, ids, strict=True))
        return made

    def _cut(self, chunk: str) -> list[str]:
        """The words of a chunk; the strings of special tokens are words of their own."""
        if "<|" not in chunk:
            return self._plain_words(chunk)
        words, start = [], 0
        for found in self.special.finditer(chunk):
            words += self._plain_words(chunk[start : found.start()])
            words.append(found.group())
            start = found.end()
        return words + self._plain_words(chunk[start:])

    def _plain_words(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            # Lower case character by character: str.lower() alone gives a final sigma its own form.
            chunk = unicodedata.normalize("NFC", chunk).replace("\u03a3", "\u03c3")
        return self.cut(chunk.lower())

    def _encode_block(self, texts: list[str]) -> list[bytes]:
        if self.kept_bytes > KEPT_BYTES:
            self._empty_tables()
        split = [[c for c in SPACES.split(t) if c] if SEPARATORS.search(t) else t.split() for t in texts]
        chunks, words = self.chunks, self.words
        new = {chunk: self._cut(chunk) for chunk in set().union(*split) if chunk not in chunks}
        new_words = self._encode_words([word for word in set().union(*new.values()) if word not in words])
        here = {chunk: b"".join([words[word] if word in words else new_words[word] for word in cut]) for chunk, cut in new.items()}
        self._keep(words, new_words)
        self._keep(chunks, here)
        return [b"".join([chunks[chunk] if chunk in chunks else here[chunk] for chunk in parts]) for parts in split]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if max(map(len, texts), default=0) <= BLOCK_CHARS:
            return self._encode_block(texts)
        return [b"".join([self._encode_block([block])[0] for block in blocks_of(text)]) for text in texts]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode_pieces(self, ids: bytes, block: int = 1 << 16) -> Iterator[str]:
        """The vocabulary's tokens joined by blanks: it names no decoder that would glue them."""
        numbers, name = np.frombuffer(ids, "<u4"), self.vocabulary.tokens.__getitem__
        for start in range(0, len(numbers), block):
            yield (" " if start else "") + " ".join(map(name, numbers[start : start + block].tolist()))

    def decode(self, ids: bytes) -> str:
        return "".join(self.decode_pieces(ids))


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_codecs: dict[str, Codec] = {}


def worker_codec(key: str, vocabulary: Vocabulary) -> Codec:
    """One codec per vocabulary in a Python worker, so its table of chunks serves all tasks."""
    if key not in _codecs:
        _codecs[key] = Codec(vocabulary)
    return _codecs[key]


def _shared_vocabulary(spark: SparkSession, path: str):
    """The vocabulary read on the driver and sent to each worker once; its size is fixed."""
    return spark.sparkContext.broadcast(_vocabulary(path))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)`` with the ids as little-endian unsigned 32-bit integers."""
    shared = _shared_vocabulary(docs.sparkSession, path)

    def rows(keys, texts):
        return list(zip(keys, worker_codec(path, shared.value).encode_many([t or "" for t in texts]), strict=True))

    return map_columns(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), ["doc_id", "text"], "doc_id long, ids binary", rows)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``."""
    shared = _shared_vocabulary(encoded.sparkSession, path)

    def row(key, ids):
        return key, worker_codec(path, shared.value).decode(ids or b"")

    return map_rows(encoded, ["doc_id", "ids"], "doc_id long, text string", row)


def _digest_of_decoded(codec: Codec, ids: bytes) -> str:
    """Decodes again, a block at a time."""
    back = hashlib.sha256()
    for piece in codec.decode_pieces(ids):
        back.update(piece.encode())
    return back.hexdigest()


def encoded_with_digest(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``: the ids, and the digest of what they decode to."""
    shared = _shared_vocabulary(docs.sparkSession, path)

    def rows(keys, texts):
        codec = worker_codec(path, shared.value)
        encoded = codec.encode_many([t or "" for t in texts])
        return [(key, len(ids) // 4, ids, _digest_of_decoded(codec, ids)) for key, ids in zip(keys, encoded, strict=True)]

    return map_columns(docs, ["doc_id", "text"], "doc_id long, n_tokens long, ids binary, decoded_sha256 string", rows)


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: both ways in one pass."""
    encoded = encoded_with_digest(docs, path)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")
