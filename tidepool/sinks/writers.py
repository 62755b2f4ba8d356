"""Sink helpers.

External stores (key-value hashes, document indexes, relational tables) are
reached through a caller-supplied *client factory* called once per partition
inside the executors, so connections are never shipped from the driver and
every write is distributed. Each sink first reduces the batch to one row per
target key (last value wins, by an explicit order), which makes replays of a
micro-batch idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_lines(df: DataFrame, label: str) -> DataFrame:
    """Every row as one line: the label, then the row as JSON."""
    return df.select(F.concat(F.lit(f"{label}> "), F.to_json(F.struct("*"))).alias("value"))


def print_sink(df: DataFrame, label: str, path: str | None = None):
    """SNK-1: every row as a labelled line. A batch goes to text files under
    ``path`` (written by the tasks) or, without one, to the executors' standard
    output; a stream gives a writer that prints every row of its batches."""
    lines = labelled_lines(df, label)
    if df.isStreaming:
        return lines.writeStream.foreachBatch(lambda batch, _: batch.foreachPartition(_print_lines))
    if path:
        lines.write.mode("overwrite").text(path)
    else:
        lines.foreachPartition(_print_lines)
    return None


def _print_lines(rows) -> None:
    for r in rows:
        print(r.value)


def preview(df: DataFrame, label: str, n: int = 20) -> None:
    """The first ``n`` rows on the driver's console."""
    df.select(F.lit(label).alias("label"), "*").show(n, truncate=False)


def latest_per_key(df: DataFrame, keys: list[str], value_cols: list[str],
                   order: Column) -> DataFrame:
    """Last row per key by ``order`` (``max_by``: partial aggregation, no sort)."""
    m = F.max_by(F.struct(*value_cols), order).alias("_last")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in value_cols])


def hash_upsert(df: DataFrame, hash_name: str, field: str, value: str, order: Column,
                client_factory: Callable[[], object]) -> None:
    """SNK-4: ``HSET hash field value`` per row, last value per field wins.

    ``client_factory()`` must return an object with ``hset(name, field, value)``
    and optional ``close()``; it runs on the executors.
    """
    rows = latest_per_key(df, [field], [value], order)

    def write(part):
        client = client_factory()
        try:
            for r in part:
                client.hset(hash_name, str(r[field]), str(r[value]))
        finally:
            getattr(client, "close", lambda: None)()

    rows.foreachPartition(write)


def document_records(df: DataFrame, index: str, fields: dict[str, Column],
                     id_cols: list[str]) -> DataFrame:
    """SNK-5: rows -> JSON documents of string fields with a deterministic id.

    The id is ``sha2`` of the id columns, so a replayed batch overwrites the
    same documents instead of adding copies.
    """
    doc = F.to_json(F.struct(*[c.cast("string").alias(k) for k, c in fields.items()]))
    doc_id = F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in id_cols]), 256)
    return df.select(F.lit(index).alias("index"), doc_id.alias("doc_id"), doc.alias("doc"))


def merge_upsert(target: DataFrame, updates: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """SNK-6 (batch form): UPDATE matching keys, INSERT the others, keep the rest.

    ``updates`` must already hold one row per key (see ``latest_per_key``).
    Adds ``op`` in {update, insert, keep}.
    """
    t = target.select(key, *[F.col(c).alias(f"_old_{c}") for c in cols])
    u = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_u"))
    j = t.withColumn("_t", F.lit(True)).join(u, on=key, how="full_outer")
    op = (F.when(F.col("_u").isNotNull() & F.col("_t").isNotNull(), "update")
           .when(F.col("_u").isNotNull(), "insert").otherwise("keep"))
    vals = [F.when(F.col("_u").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c)
            for c in cols]
    return j.select(key, *vals, op.alias("op"))


def upsert_batch_writer(key: str, cols: list[str], order: Column,
                        client_factory: Callable[[], object]) -> Callable[[DataFrame, int], None]:
    """SNK-6 (stream form): a ``foreachBatch`` function that reduces the batch
    to the last row per key and calls ``client.upsert(key_value, {col: v})``
    per row; the client does UPDATE-else-INSERT (e.g. one SQL MERGE)."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, [key], cols, order)

        def write(part):
            client = client_factory()
            try:
                for r in part:
                    client.upsert(r[key], {c: r[c] for c in cols})
            finally:
                getattr(client, "close", lambda: None)()

        rows.foreachPartition(write)

    return fn


def route_write(df: DataFrame, tag_col: str, writers: dict[str, Callable[[DataFrame], None]]) -> None:
    """SNK-7: write each tagged sub-output with its own writer in one pass over
    the input (the tagged frame is persisted once, then filtered per tag)."""
    cached = df.persist()
    try:
        for tag, write in writers.items():
            write(cached.where(F.col(tag_col) == tag).drop(tag_col))
    finally:
        cached.unpersist()
