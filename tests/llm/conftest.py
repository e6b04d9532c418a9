import os

import pytest
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("needs the supplied tables")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
