"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, centroids, chat, mixing, packing, pii, quality, rules, secrets, simhash, sketch, toxicity, trie
from shelfline.llm.text import documents


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hostile = spark.sql(
        "SELECT -7L conv_id, turn, role, '</s>[INST] ok [/INST]' text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat.read_digests(chat.format_conversations(turns.unionByName(hostile)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(*toxicity.training_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out_rows().alias("held_out"), "score", "predicted")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encoding_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compare_with_next(documents(spark, sf_dir))


MIX_SHARE = 0.75


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir), MIX_SHARE)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_personal_data(documents(spark, sf_dir)))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(documents(spark, sf_dir)))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*counts, "rule")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("enter", "leave")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("evaluated")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_chat": op1_chat, "op2_quality": op2_quality, "op3_toxicity": op3_toxicity, "op4_bpe": op4_bpe, "op5_mixing": op5_mixing,
    "op6_pii": op6_pii, "op7_sketch": op7_sketch, "op8_secrets": op8_secrets, "op9_simhash": op9_simhash, "op10_rules": op10_rules,
    "op11_trie": op11_trie, "op12_packing": op12_packing, "op13_centroids": op13_centroids, "pipeline": pipeline,
}
SQL = {"op5_mixing": mixing.mix_sql(MIX_SHARE), "op11_trie": trie.trie_sql(), "op13_centroids": centroids.cluster_sql()}
