"""Packing documents into training sequences by the harmonic method.

A sequence holds ``capacity`` token ids. Lengths are put in reciprocal classes: a piece of class
``k`` has at most ``capacity // k`` ids, and a sequence of class ``k`` is full when it holds ``k``
pieces. No sequence waits for a fitting length, so every task fills the sequences of all classes on
its own, with one open sequence per class, and no row is shuffled.

A document may be cut, which keeps the classes tight. It first gives pieces of ``capacity`` ids
(class 1). Of a rest of ``n`` ids, with ``k = capacity // n``:

- if ``k`` such pieces leave at most ``slack`` ids of a sequence empty, the rest is one piece of
  class ``k``;
- otherwise it gives a piece of exactly ``capacity // (k + 1)`` ids to class ``k + 1``, and what
  is left is cut by the same rule. A rest of ``slack`` ids or fewer is never cut.

When a task has read its rows, the pieces in its open sequences (fewer than ``capacity`` ids per
class) are laid end to end and cut at ``capacity``. The last, shorter stretch becomes sequences
with a power of two of ids, which need no padding. So what a task pads does not depend on how few
documents it reads.

Ids are those of the ``tokenizers`` library for a byte-level vocabulary, followed by ``end_id``.
They are made by ``tiktoken`` from the same vocabulary, which takes a quarter of the time; both
agree on every code point (tested). Long texts are encoded in blocks, cut at a blank before a
non-blank, where a word always starts; of a document only the unfinished piece and the checks of
its pieces are held.

Sequence numbers are the task's number times 2**33 plus a running number, so a task that is run
again gives the same ones if its input has a fixed order, as a stored table has.

Nulls and odd rows: a null text is empty; an empty text is one piece with ``end_id`` alone. Null
and repeated ids keep their rows: every row is a document of its own. An empty table gives no
pieces. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.bpe import byte_symbols
from shelfline.llm.text import pieces

CAPACITY = 1024
SLACK = 16
END_ID = 0
BLOCK_CHARS = 1 << 20
ROWS_OUT = 8192

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, class int"
# The byte-level pattern of words (fixed value), and the places where a word always starts.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_START = re.compile(r" (?=\S)")


class Encoder:
    """Token ids of texts with a byte-level vocabulary of the ``tokenizers`` library (its file's
    content), little-endian unsigned 32-bit. The ids are those of ``Tokenizer.encode`` without
    added special tokens; special tokens that a text spells out are one id, as there."""

    def __init__(self, spec: str):
        import tiktoken

        parsed = json.loads(spec)
        model = parsed["model"]
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        special = {token["content"]: token["id"] for token in parsed["added_tokens"]}
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        made = [model["vocab"][left + right] for left, right in merges]
        if made != sorted(made):
            raise ValueError("the ids of merged tokens must rise with the ranks of their merges")
        ranks = {bytes(byte_of[c] for c in token): number for token, number in model["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def blocks(self, text: str, size: int = BLOCK_CHARS) -> Iterator[bytes]:
        """The ids of a text in order, some at a time."""
        start = 0
        while start < len(text):
            cut = _WORD_START.search(text, start + size) if len(text) - start > size else None
            stop = cut.start() if cut else len(text)
            yield self.encoding.encode_to_numpy(text[start:stop], allowed_special="all").astype("<u4").tobytes()
            start = stop


def rest_classes(n: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """``(length, class)`` of the pieces of a rest of ``n`` ids, ``n < capacity``."""
    pieces = []
    while n:
        k = capacity // n
        if n <= slack or capacity - k * n <= slack:
            pieces.append((n, k))
            break
        pieces.append((capacity // (k + 1), k + 1))
        n -= capacity // (k + 1)
    return pieces


class Packer:
    """The open sequences of one task. Pieces are ``(doc_id, start, ids, doc_tokens)``."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, slack: int = SLACK):
        self.capacity, self.slack, self.next_sequence = capacity, slack, first_sequence
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple], k: int) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            length = len(ids) // 4
            self.rows.append((key, start, length, zlib.crc32(ids), total, self.next_sequence, offset, k))
            offset += length
        self.next_sequence += 1

    def add(self, key, blocks: Iterator[bytes]) -> None:
        """A document, as the blocks of its ids."""
        width, held, start, full = 4 * self.capacity, b"", 0, []
        for block in blocks:
            held += block
            stop = len(held) - len(held) % width
            view = memoryview(held)
            full += [zlib.crc32(view[at : at + width]) for at in range(0, stop, width)]
            held = held[stop:]
        total = len(full) * self.capacity + len(held) // 4
        for check in full:
            self.rows.append((key, start, self.capacity, check, total, self.next_sequence, 0, 1))
            self.next_sequence += 1
            start += self.capacity
        at = 0
        for length, k in rest_classes(len(held) // 4, self.capacity, self.slack):
            ids = held[4 * at : 4 * (at + length)]
            pieces = self.open.setdefault(k, [])
            pieces.append((key, start + at, ids, total))
            at += length
            if len(pieces) == k:
                self._close(pieces, k)
                pieces.clear()

    def finish(self) -> None:
        """Closes what is open: full sequences first, then powers of two."""
        left = [piece for k in sorted(self.open) for piece in self.open[k]]
        self.open.clear()
        rest = sum(len(ids) for _, _, ids, _ in left) // 4
        sizes = [self.capacity] * (rest // self.capacity)
        sizes += [1 << bit for bit in reversed(range(self.capacity.bit_length())) if rest % self.capacity >> bit & 1]
        left.reverse()
        for size in sizes:
            taken = []
            while size:
                key, start, ids, total = left.pop()
                if len(ids) > 4 * size:
                    left.append((key, start + size, ids[4 * size :], total))
                    ids = ids[: 4 * size]
                taken.append((key, start, ids, total))
                size -= len(ids) // 4
            self._close(taken, 0)

    def take_rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * 8
        self.rows = []
        names = [part.strip().split()[0] for part in SCHEMA.split(",")]
        kinds = [pa.int64()] * 7 + [pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)


_encoders: dict[str, Encoder] = {}


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, slack: int = SLACK, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece, as ``SCHEMA``: where it stands in its document and in its sequence.
    ``class`` is the number of pieces of its sequence, 0 for the sequences that close a task.
    ``path`` is a vocabulary of the ``tokenizers`` library; the driver reads it and sends it to
    the workers once, its size is fixed."""
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(shared.value)
        encoder, packer = _encoders[path], Packer(TaskContext.get().partitionId() << 33, capacity, slack)

        def ids(text):
            yield from encoder.blocks(text)
            yield end

        for batch in pieces(batches):
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, key in enumerate(keys):
                packer.add(key, ids(texts[i].as_py() or ""))
            if len(packer.rows) >= ROWS_OUT:
                yield packer.take_rows()
        packer.finish()
        yield packer.take_rows()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
