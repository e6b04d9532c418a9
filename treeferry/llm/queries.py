"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from treeferry.llm import (
    conversation_repair,
    exact_dedup,
    jaccard_join,
    license_scan,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    spelling_variants,
    token_planes,
    url_filter,
    vector_search,
    warc_zstd,
)
from treeferry.scratch import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", end=1)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_mixing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept share and marginal errors of that mix."""
    return mixing.report(written(op3_mixing(spark, sf_dir), "mixed"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.round_trip(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end=2)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.read_archives(warc_zstd.write_archives(table(spark, sf_dir, "pages")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search_hundredths(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_planes": op7_token_planes,
    "op8_url_filter": op8_url_filter,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
    "op3_mixing_report": op3_mixing_report,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_vector_search": op13_vector_search,
}
