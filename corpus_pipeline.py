"""The corpus pipeline: documents are graded, deduplicated three ways, and packed for training.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
Documents without an id can't be told apart and are left out by the first stage; null texts count as empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide.llm import exact_dedup, packing, quality, repeated_spans, setsketch
from glycotide.llm.shared import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are likelier clean and good than not, by a model fitted on the labels; the rest go."""
    docs = docs.filter(F.col("doc_id").isNotNull())
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), quality.grade_column(), 3)
    return quality.keep_good(docs, model, least=2)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the largest id, of each text."""
    return exact_dedup.without_copies(docs, f"pipeline_digests_{uuid.uuid4().hex}")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each component of near copies."""
    return setsketch.without_near_duplicates(docs, 75, 100, k=5)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages of 400 bytes and more that start at several places out of the texts; all documents stay."""
    return repeated_spans.without_repeated(docs, length=400).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeated_passages),
    ("best_fit_packing", packed),
]
#: A fitted classifier and a tokenizer can't be said in SQL; tests/llm/test_corpus_pipeline.py holds each stage of a small chain against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
