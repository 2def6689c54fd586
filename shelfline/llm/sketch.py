"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``k`` smallest distinct hashes of a text's five-word shingles, in order. The
smallest of a union are among the smallest of its parts, so sketches of parts merge into the
sketch of the whole. Two sketches estimate resemblance (shared over all shingles), containment
(shared over one text's shingles) and one estimates the number of distinct shingles. Texts with
fewer than ``k`` shingles are compared exactly.

A sketch is a string: the hashes as big-endian 64-bit integers in base64. Nulls: a null text is
empty. An empty text has the empty sketch; two empty sketches are alike (1), an empty and another
are not (0). A text of fewer than five words is one shingle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.text import map_rows, pieces, shingle_hashes
from shelfline.sources.shared import store

K = 256
WIDTH = 5
BUCKET_BYTES = 32 << 20


def sketch(text: str, k: int = K, width: int = WIDTH) -> np.ndarray:
    """The ``k`` smallest distinct shingle hashes, ascending."""
    smallest = np.empty(0, np.uint64)
    for hashes in shingle_hashes(text.encode().split(), width):
        if len(smallest) == k:
            hashes = hashes[hashes < smallest[-1]]
        smallest = np.unique(np.concatenate([smallest, hashes]))[:k]
    return smallest


def to_string(values: np.ndarray) -> str:
    return base64.b64encode(values.astype(">u8").tobytes()).decode()


def from_string(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Shared shingles over all shingles of two texts: the share of the union's smallest ``k``
    that both have."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    shared = np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)
    return len(shared) / len(union)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Exact below ``k``; else from how far the ``k`` smallest reach into the range of hashes."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of the first text's shingles that the second has."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, shared / distinct_count(a, k))


def sketch_documents(docs: DataFrame, k: int = K, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)``."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(named, ["doc_id", "text"], "doc_id long, fingerprint string", lambda key, text: (key, to_string(sketch(text or "", k, width))))


def merge_sketches(sketches: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """``(*keys, fingerprint)``: one sketch per group. Hashes are reduced to distinct ones before
    the shuffle, and the ranking keeps ``k`` of them per group and task before it shuffles."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = [from_string(text or "") for text in batch.column("fingerprint").to_pylist()]
            rows = np.repeat(np.arange(len(values)), [len(v) for v in values])
            # a signed long in the order of the unsigned hash
            flat = np.concatenate([*values, np.empty(0, np.uint64)]) ^ np.uint64(1 << 63)
            columns = [batch.column(key).take(pa.array(rows)) for key in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flat.view(np.int64))], [*keys, "h"])

    narrow = sketches.select(*keys, "fingerprint")
    schema = narrow.select(*keys).schema.add("h", "long")
    hashes = narrow.mapInArrow(explode, schema).distinct()
    best = hashes.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("h"))).where(F.col("n") <= k)
    lists = best.groupBy(*keys).agg(F.sort_array(F.collect_list("h")).alias("hashes"))
    flat = F.aggregate(
        "hashes", F.lit("").cast("string"),
        lambda text, h: F.concat(text, F.lpad(F.hex(h.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")),
    )
    found = lists.select(*keys, F.base64(F.unhex(flat)).alias("fingerprint"))
    return sketches.select(*keys).distinct().join(found, [sketches[key].eqNullSafe(found[key]) for key in keys], "left").select(
        *[sketches[key] for key in keys], F.coalesce(F.regexp_replace(found.fingerprint, "[\r\n]", ""), F.lit("")).alias("fingerprint")
    )


# ---- each document against its edited text and the next document ----------------------------


def _neighbours(docs: DataFrame, bucket_bytes: int) -> DataFrame:
    """Rows sorted by descending id within buckets of neighbouring ids, and each bucket followed
    by a copy of the row that comes next (``copy``), so that a task sees every row's successor.

    One shuffle of the texts. What comes to the driver is one id per bucket.
    """
    key = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place")
    rows = docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = rows.approxQuantile("place", probabilities, 0.2 / buckets) if probabilities else []
    bounds = np.unique(np.array(cuts, np.int64))

    def numbered(values: pd.Series) -> np.ndarray:
        return (len(bounds) - np.searchsorted(bounds, values.to_numpy(), side="left")).astype(np.int32)

    @F.pandas_udf("int")
    def bucket_of(values: pd.Series) -> pd.Series:
        return pd.Series(numbered(values))

    heads = rows.select("place", bucket_of("place").alias("bucket")).groupBy("bucket").agg(F.max("place").alias("head")).collect()
    heads = sorted((row["head"], row["bucket"]) for row in heads)
    places = np.array([head for head, _ in heads], np.int64)
    previous = np.array([bucket for _, bucket in [*heads[1:], *heads[:1]]], np.int32)  # the first follows the last

    @F.pandas_udf("array<int>")
    def buckets_of(values: pd.Series) -> pd.Series:
        """The row's bucket, and for the head of a bucket the bucket that it follows."""
        own = numbered(values)
        at = np.searchsorted(places, values.to_numpy()).clip(max=len(places) - 1)
        head = places[at] == values.to_numpy()
        return pd.Series([[o, previous[i]] if h else [o] for o, i, h in zip(own, at, head, strict=True)])

    placed = rows.select("place", "doc_id", "text", F.posexplode(buckets_of("place")).alias("copy", "bucket"))
    # One bucket per task: by the hash of its number, a task would get several.
    return placed.repartitionById(len(bounds) + 1, "bucket").sortWithinPartitions("bucket", "copy", F.desc("place"), "text")


def compare_with_next(docs: DataFrame, k: int = K, width: int = WIDTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """For each document in descending id order: its edited text (the last half of its characters
    replaced by the first as many of the next document; after the last comes the first), both
    sketches, and the likeness of its own to the edited one's and to the next document's.

    Rows that repeat an id follow each other by text; a null id counts as the smallest. Tasks
    stream their sorted rows and hold two at a time.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (bucket, doc_id, text, sketch) of the row that waits for its successor
        for batch in pieces(batches):
            made = []
            for bucket, copy, key, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")), strict=True):
                own = None
                if held is not None and held[0] == bucket:
                    _, doc_id, before, mine = held
                    half = len(before) // 2
                    edited = before[: len(before) - half] + text[:half]
                    theirs, changed = sketch(text, k, width), sketch(edited, k, width)
                    made.append((
                        doc_id, len(before), hashlib.sha256(edited.encode()).hexdigest(), to_string(mine), to_string(changed),
                        resemblance(mine, changed, k), resemblance(mine, theirs, k),
                    ))
                    own = theirs
                if copy:
                    held = None  # more copies of the head's id may follow; the first is the successor
                else:
                    held = (bucket, key, text, own if own is not None else sketch(text, k, width))
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)], names
            )

    return _neighbours(docs, bucket_bytes).select("bucket", "copy", "doc_id", "text").mapInArrow(run, schema)


def store_sketches(docs: DataFrame, name: str = "sketches") -> DataFrame:
    return store(sketch_documents(docs), name)
