"""Kafka adapters (SRC-4, SRC-6, SNK-2, SNK-3).

The Kafka connector jar is a deploy-time dependency (``spark-sql-kafka``);
these helpers only build the reader/writer options and the value schema, so
they can be unit-tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def kafka_source_options(topic: str, servers: str, starting: str = "latest",
                         isolation: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting}
    if isolation:
        opts["kafka.isolation.level"] = isolation
    return opts


def kafka_source(spark: SparkSession, topic: str, servers: str, starting: str = "latest",
                 isolation: str | None = None) -> DataFrame:
    """SRC-4: string values of a topic. Offsets are tracked in the checkpoint."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_source_options(topic, servers, starting, isolation).items():
        r = r.option(k, v)
    return as_lines(r.load())


def as_lines(kafka_df: DataFrame) -> DataFrame:
    """Kafka rows -> ``value`` string column (plus topic/partition/offset)."""
    return kafka_df.select(F.col("value").cast("string").alias("value"), "topic", "partition",
                           "offset")


def kafka_records(df: DataFrame, value_col: str = "value", key_col: str | None = None,
                  dedup_cols: list[str] | None = None, extra: list[str] | None = None) -> DataFrame:
    """Shape rows for the Kafka sink: ``key``/``value`` strings (and ``extra`` columns as they are).

    SNK-3: Spark's Kafka sink is at-least-once. With ``dedup_cols`` the key is
    a deterministic hash of those columns, so consumers can drop replays.
    """
    if dedup_cols:
        key = F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in dedup_cols]), 256)
    elif key_col:
        key = F.col(key_col).cast("string")
    else:
        key = F.lit(None).cast("string")
    return df.select(key.alias("key"), F.col(value_col).cast("string").alias("value"), *(extra or []))


def kafka_sink_options(topic: str, servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_sink(sdf: DataFrame, topic: str, servers: str, checkpoint: str, fmt: str = "kafka"):
    """SNK-2: a stream writer for records of ``kafka_records`` (or
    ``with_record_headers``); the caller starts it. ``fmt``: another format that
    takes such records, e.g. one of ``sinks.datasource.target_format``."""
    w = sdf.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for k, v in kafka_sink_options(topic, servers).items():
        w = w.option(k, v)
    return w


HEADERS = "array<struct<key:string,value:binary>>"


def with_record_headers(batch: DataFrame, batch_id: int, id_cols: list[str] | None = None) -> DataFrame:
    """SNK-3: records of one micro-batch with headers ``batch_id`` and ``row_id``,
    for use in ``foreachBatch``. A replayed batch gives the same headers.

    ``row_id`` is a hash of ``id_cols`` where these identify a row. Without them it
    is a hash of all columns and a number among equal rows (which are
    interchangeable), at the price of a shuffle.
    """
    cols = batch.columns
    if id_cols:
        row_id = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in id_cols]), 256)
        rows = batch.withColumn("__row_id", row_id)
    else:
        digest = F.sha2(F.to_json(F.struct(*cols)), 256)
        rows = batch.withColumn("__digest", digest)
        nth = F.row_number().over(Window.partitionBy("__digest").orderBy(F.lit(0)))
        rows = rows.withColumn("__row_id", F.concat_ws("-", "__digest", nth.cast("string"))).drop("__digest")
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
    headers = F.array(header("batch_id", F.lit(batch_id)), header("row_id", F.col("__row_id"))).cast(HEADERS)
    return rows.select(*cols, headers.alias("headers")).drop("__row_id")


def header_value(name: str):
    """A header of a record, as text."""
    return F.element_at(F.filter("headers", lambda h: h["key"] == name), 1)["value"].cast("string")


def drop_replayed(records: DataFrame, ts: str, within_s: int) -> DataFrame:
    """SNK-3, reading side: records without the copies that replayed batches
    left, by their headers. State is kept for ``within_s`` of event time, the
    longest time between a batch and its replay. Records without headers are not
    of this writer and are left out."""
    marked = records.withWatermark(ts, f"{int(within_s)} seconds").select("*", header_value("batch_id").alias("__b"), header_value("row_id").alias("__r"))
    return marked.where("__r IS NOT NULL").dropDuplicatesWithinWatermark(["__b", "__r"]).drop("__b", "__r")


def load_to_kafka(df: DataFrame, topic: str, servers: str, value_col: str = "value") -> None:
    """SRC-6: bulk load lines into a topic as one distributed batch write."""
    w = kafka_records(df, value_col).write.format("kafka")
    for k, v in kafka_sink_options(topic, servers).items():
        w = w.option(k, v)
    w.save()
