"""Loader for the driver's Parquet tables.

``TIMESTAMP_NTZ`` columns are cast to ``TIMESTAMP`` (session zone is UTC, so
the wall-clock value is kept) because event-time operators such as
``withWatermark`` only accept ``TIMESTAMP``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _ntz_to_ts(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _ntz_to_ts(spark.read.parquet(table_path(sf_dir, name)))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as TIMESTAMP and the item id parsed from props."""
    ev = load_table(spark, sf_dir, "events")
    return ev.withColumn("item_id", F.get_json_object("props", "$.k").cast("bigint"))
