"""Where a job keeps its tables: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors reach.

    On a cluster the setting is required: a folder of the driver's machine would be
    another one on each executor. Only in local mode, where there is one machine, an
    unset setting is set here, once for the session, to a new temporary folder.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="treeferry-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses (not created yet)."""
    return f"{shared_folder(spark)}/treeferry-{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def written(frame: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Run ``frame`` once, as a table in the shared folder or at ``path``, and read that table.
    ``compression`` is of the session where it is not given.

    The table outlives lost executors, cuts the lineage, and gives Catalyst the real
    size of the data for its join choices.
    """
    spark = frame.sparkSession
    path = path or new_folder(spark, name)
    frame.write.parquet(path, compression=compression)
    return read_table(spark, path, frame.schema)
