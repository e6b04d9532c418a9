"""What a job takes from the Spark session."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from treeferry.functions.paths import URI_PATTERN

ROWS_PER_SHUFFLE_PARTITION = 1_000_000


def default_filesystem(spark: SparkSession) -> tuple[str, str]:
    """URI and working directory of the session's default filesystem."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    filesystem = spark._jvm.org.apache.hadoop.fs.FileSystem.get(hadoop)
    return filesystem.getUri().toString(), filesystem.getWorkingDirectory().toUri().getPath()


def qualify(path: str, default_fs: str, working_dir: str) -> str:
    """``qualify_path`` of one path on the driver, where a Spark job would be a waste."""
    default_scheme, _, rest = default_fs.partition("://")
    scheme, authority, tail = (part or "" for part in re.match(URI_PATTERN, path).groups())
    if not tail.startswith("/"):
        if not tail and not authority:
            raise ValueError(f"no path: {path!r}")
        if tail and scheme:
            raise ValueError(f"relative path after a scheme: {path}")
        tail = f"{working_dir}/{tail}" if tail else "/"
    if not authority and scheme in ("", default_scheme):
        authority = rest.partition("/")[0]
    kept: list[str] = []
    for part in tail.split("/"):
        if part == ".." and kept and kept[-1] != "..":
            kept.pop()
        elif part not in ("", "."):
            kept.append(part)
    return f"{scheme or default_scheme}://{authority}/{'/'.join(kept)}"


def qualified(spark: SparkSession, *paths: str) -> list[str]:
    """Paths in the spelling that all tables use."""
    default_fs, working_dir = default_filesystem(spark)
    return [qualify(path, default_fs, working_dir) for path in paths]


def speculates(spark: SparkSession) -> bool:
    return spark.conf.get("spark.speculation", "false").lower() == "true"


def spread_by(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """Partition by ``key``, ahead of a join or window on it, where the session's number
    of shuffle partitions would give partitions too large for a task's memory."""
    wanted = -(-rows // ROWS_PER_SHUFFLE_PARTITION)
    usual = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(wanted, key) if wanted > usual else frame


def side_by_side(spark: SparkSession, *steps: Callable) -> list:
    """Run steps that do not depend on each other at once; their results in order.
    Each step's jobs share the cluster, so one step's last tasks leave no idle cores."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]
