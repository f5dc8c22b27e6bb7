"""The corpus pipeline: documents to token ids of clean, distinct, uncontaminated texts.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import staging
from corpusmill.llm import decontaminate, piece_codec, quality_knn, secret_scan, simhash
from corpusmill.llm.common import table
from corpusmill.llm.queries import TOKENIZER, quality_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    scored = quality_knn.classify(docs, quality_model(spark, sf_dir, docs))
    return scored.where(F.col("result.score") >= quality_knn.THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and ``n_chars`` of changed texts renewed."""
    return secret_scan.redact_secrets(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens`` of all documents."""
    codec = piece_codec.load(piece_codec.read_model(spark, TOKENIZER))
    coded = piece_codec.encode(docs, codec, keep=["doc_id", "lang", "source"])
    return coded.select("row.*", "result.ids", "result.n_tokens")


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("secrets", mask_secrets),
    ("encode", encode_texts),
]

#: SQL expresses neither the classifier nor fingerprints, tiles, novelty and pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
