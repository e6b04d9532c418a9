"""Summaries of manifests and of what a run did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "source string, destination string, file_type string, outcome string, bytes bigint, "
    "temp_path string, error string, task_attempt_id bigint"
)
OUTCOMES = ("dir_exists", "dir_created", "copied", "replaced", "deleted", "absent", "skipped", "failed", "finished", "undone", "untouched")


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Entries and bytes of a listing by type."""
    return manifest.groupBy("file_type").agg(
        F.count("*").alias("entries"), F.coalesce(F.sum("len"), F.lit(0)).alias("bytes")
    )


def copy_report(report: DataFrame) -> DataFrame:
    """What happened to each entry, without the columns that differ between runs."""
    return report.select("source", "destination", "file_type", "outcome", "bytes", "error")


def report_summary(report: DataFrame) -> DataFrame:
    """Entries and bytes of a report by type and outcome."""
    return report.groupBy("file_type", "outcome").agg(
        F.count("*").alias("entries"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )
