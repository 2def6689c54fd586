"""What the text operators share: words, word shingles, and small pieces of batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six ASCII blanks; bytes.split() uses the same six.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"
PIECE_ROWS = 256
PIECE_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches of a worker in pieces of at most ``rows`` rows, and ``size`` bytes unless one
    row is longer: what Python makes of a piece is many times its size. Nothing is copied, and no
    setting of the session is changed."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            waiting = [batch.slice(start, rows)]
            while waiting:
                piece = waiting.pop()
                if piece.num_rows > 1 and piece.nbytes > size:
                    half = piece.num_rows // 2
                    waiting += [piece.slice(half), piece.slice(0, half)]
                else:
                    yield piece


def map_columns(df: DataFrame, columns: list[str], schema: str, make: Callable[..., list]) -> DataFrame:
    """``make(*lists)`` turns the columns of a piece of a batch into rows, one list of tuples."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = make(*(column.to_pylist() for column in batch.columns))
            values = list(zip(*made, strict=True)) if made else [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kinds[kind]) for v, (_, kind) in zip(values, fields, strict=True)], [name for name, _ in fields]
            )

    return df.select(*columns).mapInArrow(run, schema)


def map_rows(df: DataFrame, columns: list[str], schema: str, row: Callable[..., tuple]) -> DataFrame:
    """One output row ``row(*values)`` for each input row."""
    return map_columns(df, columns, schema, lambda *lists: [row(*values) for values in zip(*lists, strict=True)])


def shingle_hashes(words: list[bytes], width: int, block: int = 1 << 16) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every ``width``-word shingle joined by one blank, repeats included, in
    blocks. Fewer words make one shingle of all of them; no words make none."""
    if not words:
        return
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    digest, join, count = xxhash.xxh64_intdigest, b" ".join, len(words) - width + 1
    for start in range(0, count, block):
        stop = min(start + block, count)
        shifted = [words[start + i : stop + i] for i in range(width)]
        yield np.array([digest(s, 42) for s in map(join, zip(*shifted, strict=True))], np.uint64)


def empty_text(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))
