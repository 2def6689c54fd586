"""The corpus pipeline: from raw documents to token ids.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as
Parquet to the shared folder and reads it again for the next stage. All but the last return the
columns of ``documents``.

1. quality classifier: documents scored below one half go;
2. SimHash near-dedup: one document of each group of linked fingerprints stays (four-word
   shingles, four bits, as the operator's contract has it);
3. secret scans: the secrets found in texts are replaced by a mark, ``n_chars`` follows;
4. mixing: every document stays; documents of domains, languages and sources below their target
   weights are read a second time, as far as the weights ask for it;
5. BPE: token ids of what is left, with the digest of the decoded ids.

A null text passes as an empty one. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import bpe, mixing, quality, secrets, simhash
from shelfline.sources.shared import store

TOKENIZER = "word_bpe_49k.json"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded_with_digest(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", dedup),
    ("secret scans", redact),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

# Trained models and fingerprints have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = store(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
