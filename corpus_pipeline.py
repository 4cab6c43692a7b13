"""From raw documents to training sequences: toxicity, near-duplicates, repeated passages, secrets, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import neardup, packing, repeats, secrets, toxicity
from tributary.session import materialize


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of a classifier that learned from part of the labels stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.learnable(docs), toxicity.learnable(labels))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that five-word shingles link at a similarity of 0.8 the smallest id stays."""
    return neardup.without_near_duplicates(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that an earlier string of 100 bytes repeats are cut out of the texts; every document stays."""
    return _counted(repeats.without_repeats(docs, window=100))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return _counted(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: Sketches, suffix arrays and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
