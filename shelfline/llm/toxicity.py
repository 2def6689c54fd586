"""Toxicity scores by non-negative positive-unlabelled (nnPU) learning.

Confirmed toxic documents are the positives; everything else is unlabelled, toxic or not. With the
class prior ``p`` the risk of a classifier is

    p * R+(positives)  +  max(0, R-(unlabelled) - p * R-(positives))

where the second part estimates the risk on the documents that are not toxic; it cannot be
negative, and where a step would push it below zero the step is taken back (the non-negative
correction). The classifier is a linear one in numpy, over the presence of hashed byte n-grams of
the lower-cased text, with the sigmoid loss.

The positives are a hash sample of the training rows labelled toxic; the unlabelled rows are a hash
sample of all documents that are not held out, whatever their labels, which are not read for it.
The prior is the toxic share of the training labels. Fitting takes two passes over these bounded
samples (``sample_positives``, ``sample_unlabelled`` documents): document frequencies of all n-grams
among positives and unlabelled (grouped sums), of which the ``n_features`` that set the positives
apart most are kept, and the sparse rows, on which numpy fits the weights on the driver. Scoring
reads every whole text once.

Labels come only from training rows; ids, sources, languages and labels are never features. Nulls:
a null text is empty and, like an empty one, gets the score of a document without any of the
n-grams. A row without an id is scored as any other; it has no label and is not sampled. An empty
table has no rows to fit: every score is then the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import map_rows, pieces
from shelfline.sources.shared import store

SIZES = (4, 5, 6)
HASH_BITS = 20
N_FEATURES = 4096
SAMPLE_POSITIVES = 6_000
SAMPLE_UNLABELLED = 30_000
STEPS = 400
BLOCK = 1 << 20


def ngram_hashes(text: str, sizes: tuple[int, ...] = SIZES, bits: int = HASH_BITS) -> np.ndarray:
    """The distinct hashed n-grams of the lower-cased UTF-8 text. Runs of blanks count as one
    blank, and the text has one on both sides, so word starts and ends show. Long texts are
    hashed in overlapping blocks."""
    raw = np.frombuffer(b" " + b" ".join(text.lower().encode().split()) + b" ", np.uint8)
    found = []
    step = np.uint64(0x9E3779B97F4A7C15)
    for start in range(0, max(1, len(raw)), BLOCK):
        block = raw[start : start + BLOCK + max(sizes) - 1].astype(np.uint64)
        hashed = np.zeros(0, np.uint64)
        for n in range(1, max(sizes) + 1):
            if len(block) < n:
                break
            hashed = block[n - 1 :] + np.uint64(n) if n == 1 else (hashed[: len(block) - n + 1] ^ block[n - 1 :]) * step
            hashed = hashed ^ (hashed >> np.uint64(29))
            if n in sizes:
                salted = (hashed + np.uint64(n)) * step
                found.append((salted >> np.uint64(64 - bits)).astype(np.int32))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


@dataclass(frozen=True)
class Model:
    """Weights of the chosen n-grams by their hash, the bias, and in how many steps of the fit the
    risk on what is not toxic went below zero and was taken back."""

    weights: np.ndarray
    bias: float
    taken_back: int = 0

    def score(self, text: str) -> float:
        z = self.bias + float(self.weights[ngram_hashes(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_nnpu(
    positives: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int, prior: float,
    steps: int = STEPS, rate: float = 0.05, decay: float = 1e-4, caution: float = 0.1,
) -> tuple[np.ndarray, float, int]:
    """Weights and bias that minimise the non-negative risk (sigmoid loss, Adam steps), and the
    number of steps that were taken back. Such steps are ``caution`` times as long as others; the
    result is the mean over the second half of the steps, around which the two kinds alternate."""
    rows, taken_back = [*positives, *unlabelled], 0
    n_pos, n_all = len(positives), len(rows)
    features = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    lines = np.repeat(np.arange(n_all), [len(r) for r in rows])
    w, b = np.zeros(n_features), float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    mean = np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(lines, w[features], n_all)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))  # the loss of calling a row toxic; 1 - p that of not
        rise = p * (1 - p)
        negative_part = p[n_pos:].mean() - prior * p[:n_pos].mean()
        slope, length = np.zeros(n_all), rate  # of the risk by each row's z
        if negative_part >= 0:
            slope[:n_pos] = -2 * prior * rise[:n_pos] / n_pos
            slope[n_pos:] = rise[n_pos:] / len(unlabelled)
        else:  # take the step back: climb on the part that went below zero
            taken_back, length = taken_back + 1, rate * caution
            slope[:n_pos] = prior * rise[:n_pos] / n_pos
            slope[n_pos:] = -rise[n_pos:] / len(unlabelled)
        g = np.append(np.bincount(features, slope[lines], n_features) + decay * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = length * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
        if 2 * step > steps:
            mean += np.append(w, b) / (steps - steps // 2)
    return mean[:-1], float(mean[-1]), taken_back


def _frequencies(docs: DataFrame, bits: int) -> DataFrame:
    """``(h, positives, unlabelled)``: in how many documents of each kind an n-gram occurs.

    Each task adds up its documents in two arrays of fixed size, so a shuffle row per n-gram and
    task is all that moves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int64)
        for batch in pieces(batches):
            for text, positive in zip(batch.column("text").to_pylist(), batch.column("positive").to_pylist(), strict=True):
                counts[0 if positive else 1, ngram_hashes(text or "", bits=bits)] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        for start in range(0, len(seen), 1 << 16):
            h = seen[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int32)), pa.array(counts[0, h]), pa.array(counts[1, h])], ["h", "p", "u"])

    return docs.select("text", "positive").mapInArrow(run, "h int, p long, u long").groupBy("h").agg(
        F.sum("p").alias("positives"), F.sum("u").alias("unlabelled")
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, sample_positives: int = SAMPLE_POSITIVES, sample_unlabelled: int = SAMPLE_UNLABELLED
) -> tuple[DataFrame, float]:
    """``(text, positive)`` of the two bounded samples, and the toxic share of the labels of rows
    that are not held out. Labels that repeat an id count as toxic if one does. A document may be
    in both samples, as one row in each.

    Positives are chosen among the ids, below a hash threshold that lets about the wanted number
    pass: their number is bounded by the parameter, so they are broadcast and the texts are read in
    one scan for both samples.
    """

    def share(salt: int, *columns: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(1 << 30)) / float(1 << 30)

    marked = labels.where(F.col("doc_id").isNotNull() & ~held_out_rows()).groupBy("doc_id").agg(
        F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic")
    )
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_pos, n_marked = sizes.get(True, 0), sum(sizes.values())
    chosen = marked.where(F.col("toxic") & (share(17, "doc_id") < sample_positives / max(1, n_pos))).select("doc_id", F.lit(True).alias("toxic"))
    training = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & ~held_out_rows())
    in_unlabelled = share(18, "doc_id", "text") < sample_unlabelled / max(1, docs.count())
    kinds = F.concat(
        F.when(F.col("toxic"), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")),
        F.when(in_unlabelled, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>")),
    )
    texts = training.join(F.broadcast(chosen), "doc_id", "left").select("text", F.explode(kinds).alias("positive"))
    return store(texts, "toxicity-sample"), n_pos / max(1, n_marked)


def fit(sample: DataFrame, prior: float, n_features: int = N_FEATURES, bits: int = HASH_BITS) -> Model:
    """``sample`` has ``(text, positive)``: true for confirmed toxic documents, false for unlabelled.
    ``prior`` is the toxic share of the documents that will be scored."""
    kept = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not kept.get(True) or not kept.get(False):
        return Model(np.zeros(1 << bits, np.float32), float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    p, u = F.col("positives") + 1.0, F.col("unlabelled") + 1.0
    # Signed-root likelihood ratio of "occurs in a positive" against "occurs in an unlabelled".
    lift = F.log((p / kept.get(True, 1)) / (u / kept.get(False, 1)))
    chosen = (
        _frequencies(sample, bits).withColumn("strength", lift * F.sqrt(F.col("positives")))
        .where("positives >= 3").orderBy(F.desc("strength"), "h").limit(n_features).select("h").collect()
    )
    place = np.full(1 << bits, -1, np.int32)
    hashes = np.array([r["h"] for r in chosen], np.int64)
    place[hashes] = np.arange(len(hashes))

    def row(text, positive):
        at = place[ngram_hashes(text or "", bits=bits)]
        return bool(positive), at[at >= 0].astype("<i4").tobytes()

    rows = map_rows(sample, ["text", "positive"], "positive boolean, features binary", row).collect()
    sparse = {True: [], False: []}
    for positive, features in rows:
        sparse[positive].append(np.frombuffer(bytes(features), "<i4"))
    weights = np.zeros(1 << bits, np.float32)
    w, bias, taken_back = fit_nnpu(sparse[True], sparse[False], max(1, len(hashes)), prior)
    weights[hashes] = w[: len(hashes)]
    return Model(weights, bias, taken_back)


def held_out_rows(column: str = "doc_id") -> Column:
    """True for the rows kept for judging: remainder 2 of the id's CRC-32 by 4."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def row(key, text):
        score = shared.value.score(text or "")
        return key, score, int(score >= threshold)

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(named, ["doc_id", "text"], "doc_id long, score double, predicted int", row)
