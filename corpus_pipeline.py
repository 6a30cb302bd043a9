"""Training-corpus pipeline: five stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import bpe, mixing, near_duplicates, quality, secret_scan
from forecourt.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. References come from all documents of this stage."""
    return quality.keep_good(_documents(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every near-duplicate class."""
    return near_duplicates.one_per_class(_documents(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a marker; n_chars follows the text."""
    return secret_scan.redact(_documents(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target weight, in shuffled order."""
    return mixing.mix(_documents(docs)).select(*COLUMNS)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every copy."""
    return bpe.encode(_documents(docs), VOCABULARY).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode_documents),
]

#: Distances, sketches and byte-pair merges are beyond SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
