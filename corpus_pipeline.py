"""A corpus made ready for training: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.decontaminate import decontaminated
from tidemark.llm.jaccard_join import one_of_each_group
from tidemark.llm.resample import importance_resample
from tidemark.llm.suffix_dedup import without_repeats
from tidemark.session import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    scored = importance_resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter("kept").select(*[f"`{c}`" for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each_group(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur twice."""
    return without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe),
]

# Trained models, suffix sorting and BPE have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
