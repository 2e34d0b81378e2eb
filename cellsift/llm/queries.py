"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsift.llm import (
    embeddings, html, language, lines, minhash, mixing, pieces, pii, prefixes, quality, rules, sharding,
    spelling,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model() -> str:
    """The file of the public vocabulary; a path each executor has."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"), [])


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(_table(spark, folder, "documents"), [])


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    out = pieces.encode(docs, piece_model(), ids=False)
    return out.select("doc_id", "_pieces.n_tokens", "_pieces.ids_sha256", "_pieces.decoded_sha256")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return rules.apply_rules(docs, rules.learn_rules(docs, _table(spark, folder, "labels")))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(_table(spark, folder, "documents"))


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(_table(spark, folder, "pages"), [])


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(_table(spark, folder, "documents"), [])


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.scores(docs, quality.learn(docs, _table(spark, folder, "labels")))


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.classes(_table(spark, folder, "documents"), [])
    return found.selectExpr("doc_id", "class_id", "doc_id = class_id as kept")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"), [])


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.drop_repeated(_table(spark, folder, "documents").select("doc_id", "text"), [])
    return out.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2("_lines.text", 256).alias("kept_sha256"))


def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(_table(spark, folder, "conversations"), []).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language_id, op2_embedding_near_dedup, op3_sharding, op4_sentencepiece, op5_quality_rules, op6_pii,
        op7_html_extraction, op8_mixing, op9_quality_classifier, op10_minhash_near_dedup, op11_spelling_variants, op12_line_dedup,
        op13_conversation_prefix_trie, pipeline,
    )
    return {f.__name__: f for f in found}
