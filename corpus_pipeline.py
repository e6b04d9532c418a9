"""A training corpus from raw documents: quality rules, exact and near duplicates, the mix of
sources, and packed sequences. Each stage is a table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from treeferry.llm import exact_dedup, jaccard_join, mixing, packing, quality_rules
from treeferry.scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str, sample: float = mixing.SAMPLE) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights; they
    are expected to hold ``sample`` of the tokens."""
    return mixing.keep_drawn(docs, sample=sample)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Padded sequences of token ids, each with the pieces of documents that it holds."""
    pieces = packing.pack_documents(docs, "byte_bpe_50k.json", end=1, with_ids=True)
    return packing.sequences(pieces, pad=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has no tokenizer; tests hold the result against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str, sample: float = mixing.SAMPLE) -> DataFrame:
    """The sequences of a corpus, ``sample`` of whose tokens are drawn when sources are mixed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        more = {"sample": sample} if stage is mix else {}
        docs = written(stage(spark, docs, sf_dir, **more), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
