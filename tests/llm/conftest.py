import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_fixture import ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """A small ``documents`` table with nulls, empty and long texts, ties,
    repeated rows and extra columns."""
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    rows = [(d, t, "aa" if i % 2 else "bb", "s", "x", 7, "y", "z", "q", "w", "f", "v") for i, (d, t) in enumerate(ROWS)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(docs, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "empty.parquet")
    docs.limit(0).write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)
