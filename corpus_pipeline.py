"""From raw documents to encoded training text, in five stages.

Each stage takes what its predecessor wrote, works on all of it, and returns the
columns of documents; the last returns the encoded documents. A stage is written
as Parquet in the shared folder before the next one reads it, so a lost executor
costs tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellsift.llm import minhash, mixing, pieces, pii, quality
from cellsift.llm.queries import piece_model
from cellsift.sources.scratch import cut_lineage, drop_written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.learn(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(docs, [])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated to the target weights, within the limits of op8; every document stays."""
    return mixing.remix(docs, [], cover=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids_sha256, decoded_sha256, ids`` of each document."""
    out = pieces.encode(docs.select("doc_id", "source", "text"), piece_model())
    return out.select("doc_id", "source", "_pieces.*")


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: Learned, sampled and iterative stages are no SQL; tests/llm compares ``run`` with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written: list[str] = []
    for _, stage in STAGES:
        before = written
        written = []
        docs = cut_lineage(stage(spark, docs, sf_dir), "stage", written)
        drop_written(spark, before)
    return docs
