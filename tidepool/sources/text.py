"""Line sources (SRC-1, SRC-2, SRC-3, SRC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: bounded text file(s) -> ``value`` (one row per line)."""
    return spark.read.text(path)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """SRC-2: in-memory rows with an explicit schema (fixtures, small lookups)."""
    return spark.createDataFrame(rows, schema)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-3: unbounded line source over a landing directory (no socket is opened)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stream_lines_with_origin(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: tail a directory of per-partition files -> ``(origin, value)``.

    Offsets (which files were consumed) live in the query checkpoint, so a
    restart on the same checkpoint emits every line exactly once. Producers
    must land files atomically (write elsewhere, then rename into ``path``).
    """
    return (spark.readStream.format("text").load(path)
                 .select(F.col("_metadata.file_name").alias("origin"), "value"))
