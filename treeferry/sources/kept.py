"""Manifests kept between runs, bucketed by where entries go or are.

Two of the same number of buckets are compared bucket by bucket: the join finds its rows
together and in order, so a listing is shuffled once, when it is kept, and not for each
comparison with it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from treeferry.session import qualified
from treeferry.storage import Stores, make_directories

# Rows of a bucket that are aimed at; numbers of buckets are powers of two, so that two
# manifests of different size still fit: Spark joins a multiple without moving the smaller.
ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 8
# Begins so that readers of tables pass over it.
DESCRIPTION = "_manifest.json"


def keep_manifest(manifest: DataFrame, folder: str, buckets: int | None = None, options: dict | None = None) -> DataFrame:
    """Write a source or destination manifest to a new ``folder``, bucketed and sorted by
    ``destination`` or, where there is none, by ``uri``, and return it as ``kept_manifest`` does.
    ``buckets``: by default from the number of rows; give both sides of a comparison the same."""
    spark = manifest.sparkSession
    root = qualified(spark, folder)[0]
    key = "destination" if "destination" in manifest.columns else "uri"
    if not buckets:
        wanted = max(LEAST_BUCKETS, -(-manifest.count() // ROWS_PER_BUCKET))
        buckets = 1 << (wanted - 1).bit_length()
    make_directories(root, options)
    rows = manifest.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    name = _new_name()
    rows.option("path", root + "/rows").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its name alone: the files are the folder's
    store, path = Stores(options).at(f"{root}/{DESCRIPTION}")
    told = {"key": key, "buckets": buckets, "columns": [[f.name, f.dataType.simpleString()] for f in manifest.schema]}
    with store.open_new(path) as file:
        file.write(json.dumps(told).encode())
    return kept_manifest(spark, folder, options)


def kept_manifest(spark: SparkSession, folder: str, options: dict | None = None) -> DataFrame:
    """A manifest that ``keep_manifest`` wrote, by this session or an earlier one."""
    root = qualified(spark, folder)[0]
    store, path = Stores(options).at(f"{root}/{DESCRIPTION}")
    if not store.status(path):
        raise FileNotFoundError(f"{root} holds no kept manifest")
    with store.open_input(path) as file:
        told = json.loads(file.read())
    name, key = _new_name(), told["key"]
    columns = ", ".join(f"`{column}` {kind}" for column, kind in told["columns"])
    where = (root + "/rows").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {told['buckets']} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def _new_name() -> str:
    return f"treeferry_manifest_{uuid.uuid4().hex}"
