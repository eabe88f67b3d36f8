"""The numbered queries over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.decontaminate import leaks
from tidemark.llm.grid_codes import vector_codes
from tidemark.llm.html_text import extract_text
from tidemark.llm.jaccard_join import jaccard_groups
from tidemark.llm.language import languages
from tidemark.llm.license_scan import license_scan
from tidemark.llm.oracle import jaccard_groups_sql, leaks_sql, passage_digests_sql, spelling_variants_sql, vector_codes_sql
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.resample import importance_resample
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.suffix_dedup import passage_digests
from tidemark.llm.toxicity import toxicity
from tidemark.llm.url_rules import judge_urls


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    marks = _table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"), F.when(F.col("quality") == 1, "allow").when(F.col("quality") == 0, "block").alias("verdict")
    )
    return judge_urls(_table(spark, sf, "pages"), marks)


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    return importance_resample(documents, _table(spark, sf, "labels")).drop("text")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "doc_word", "item_word", "n_differ", "n_seeds")


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op5_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan(_table(spark, sf, "documents"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(_table(spark, sf, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passage_digests(_table(spark, sf, "documents"))


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_round_trip(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf, "documents"))


def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes(_table(spark, sf, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(_table(spark, sf, "documents"))


def op13_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return languages(_table(spark, sf, "documents"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scans": op5_license_scans,
    "op6_toxicity": op6_toxicity,
    "op7_html_extraction": op7_html_extraction,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_bpe": op9_bpe,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_vector_codes": op11_vector_codes,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_language_id": op13_language_id,
}
ORACLE: dict[str, str] = {
    "op3_decontamination": leaks_sql(),
    "op8_suffix_dedup": passage_digests_sql(),
    "op10_jaccard_join": jaccard_groups_sql(),
    "op11_vector_codes": vector_codes_sql(),
    "op12_spelling_variants": spelling_variants_sql(),
}
