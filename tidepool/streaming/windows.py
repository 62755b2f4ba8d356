"""Streaming windowed aggregates (WIN-*, AGG-8/9, TOP-1 on streams)."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.windows import sliding_agg_deltas, window_starts

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _agg(kind, col):
    if kind == "count":
        return F.count(F.lit(1)) if col is None else F.count(col)  # NULLs of a column don't count
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](col)


def stream_window_agg(sdf: DataFrame, ts: str, size_s: int, slide_s: int | None,
                      keys: list[str], measures: dict, delay_s: int = 0,
                      panes: bool = True) -> DataFrame:
    """Watermarked tumbling/sliding aggregate; append mode emits each window
    once, when the watermark passes its end.

    With ``panes`` a sliding window is computed as a chain of two stateful
    aggregates: tumbling panes of ``gcd(size, slide)`` then the sliding window
    over ``window_time(pane)``; state holds pane partials instead of
    ``size/slide`` copies of every row.
    """
    slide_s = slide_s or size_s
    w = sdf.withWatermark(ts, f"{int(delay_s)} seconds")
    if panes and slide_s != size_s:
        pane_s = gcd(int(size_s), int(slide_s))
        p = (w.groupBy(*keys, F.window(ts, f"{pane_s} seconds").alias("pane"))
              .agg(*[_agg(k, c).alias(n) for n, (k, c) in measures.items()]))
        out = (p.groupBy(*keys, F.window(F.window_time("pane"), f"{size_s} seconds",
                                         f"{slide_s} seconds").alias("w"))
                .agg(*[_MERGE[k](n).alias(n) for n, (k, _) in measures.items()]))
    else:
        out = (w.groupBy(*keys, F.window(ts, f"{size_s} seconds", f"{slide_s} seconds").alias("w"))
                .agg(*[_agg(k, c).alias(n) for n, (k, c) in measures.items()]))
    return out.select(*keys, F.unix_millis("w.start").alias("window_start"),
                      F.unix_millis("w.end").alias("window_end"), *measures.keys())


def stream_uv_exact(sdf: DataFrame, ts: str, user: str, size_s: int, delay_s: int = 0) -> DataFrame:
    """AGG-8 on a stream: ``countDistinct`` is not allowed on streams, so
    deduplicate (window, user) first, then count per window (both stateful,
    both evicted by the watermark)."""
    w = sdf.withWatermark(ts, f"{int(delay_s)} seconds")
    d = (w.select(F.window(ts, f"{size_s} seconds").alias("w"), user)
          .dropDuplicates(["w", user]))
    return (d.groupBy("w").agg(F.count(F.lit(1)).alias("uv"))
             .select(F.unix_millis("w.end").alias("window_end"), "uv"))


def stream_uv_running(sdf: DataFrame, ts: str, user: str, size_s: int, slide_s: int | None = None,
                      delay_s: int = 0, lg_k: int = 12) -> DataFrame:
    """AGG-9 on a stream: the running distinct count of each (sliding) window,
    for ``update`` mode: every batch gives the windows that it changed with their
    count so far. State is one sketch per open window; a task's rows are folded
    into sketches before the shuffle."""
    starts = window_starts(F.unix_micros(F.col(ts)), size_s, slide_s or size_s)
    begin = F.explode(F.transform(starts, lambda t: F.timestamp_micros(t))).alias("_start")
    w = sdf.withWatermark(ts, f"{int(delay_s)} seconds").where(F.col(ts).isNotNull()).select(F.col(ts), F.col(user), begin)
    counts = (w.groupBy(F.window("_start", f"{slide_s or size_s} seconds").alias("_w"))
               .agg(F.hll_sketch_agg(user, F.lit(lg_k)).alias("_u")))
    start = F.unix_millis("_w.start")
    return counts.select(start.alias("window_start"), (start + int(size_s) * 1000).alias("window_end"),
                         F.hll_sketch_estimate("_u").alias("uv_sketch"))


def version_batches(out_path: str):
    """A ``foreachBatch`` function that keeps every emitted version: each batch
    (over)writes its own ``batch_id=`` folder."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return fn


def rank_batches(out_path: str, partition: list[str], by: str, tie: list[str], n: int,
                 rank_col: str = "top_rank"):
    """TOP-1/2 on a stream: a ``foreachBatch`` function ranking each batch of
    finalized window counts (append mode: a window's counts arrive complete in
    one batch) with ``row_number() <= n``. Each batch overwrites its own
    ``batch_id=`` folder, so a replayed batch cannot duplicate rows."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        w = Window.partitionBy(*partition).orderBy(F.col(by).desc(), *[F.col(t) for t in tie])
        ranked = (batch.withColumn(rank_col, F.row_number().over(w))
                       .where(F.col(rank_col) <= n)
                       .withColumn(rank_col, F.col(rank_col).cast("bigint")))
        ranked.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return fn


def refine_top_n(out_path: str, partition: list[str], key: str, count: str, n: int,
                 rank_col: str = "top_rank"):
    """TOP-2 with late refinements: a ``foreachBatch`` function for an
    ``update``-mode windowed count (watermark delay = allowed lateness).

    A batch carries only the changed ``(window, key, count)`` rows, and counts
    only grow, so the new top-n of a touched window is the top-n of (its
    previous top-n ∪ the changed rows). State is therefore n rows per window.
    Each batch writes the refreshed top-n of the windows it touched as version
    ``batch_id``; ``latest_top_n`` reads the newest version per window.

    Versions lie in folders by the day of their window (``partition[0]`` is its
    end in epoch ms), and a batch reads those of the days it touches: what it
    reads is bounded by the lateness, not by the number of batches.
    """
    day = F.floor(F.col(partition[0]) / 86_400_000).cast("int")

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        upd = batch.select(*partition, key, count).persist()  # used twice: the stateful part runs once
        cand = upd
        if batch_id > 0:  # the first batch has no previous versions
            days = [r[0] for r in upd.select(day).distinct().collect()]
            prev = latest_top_n(spark.read.parquet(out_path).where(F.col("day").isin(days)), partition, rank_col)
            touched = upd.select(*partition).distinct()
            cand = cand.unionByName(prev.join(touched, on=partition, how="left_semi")
                                    .select(*partition, key, count))
        best = cand.groupBy(*partition, key).agg(F.max(count).alias(count))
        w = Window.partitionBy(*partition).orderBy(F.col(count).desc(), F.col(key))
        ranked = (best.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
                      .where(F.col(rank_col) <= n))
        ranked.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(f"{out_path}/batch_id={batch_id}")
        upd.unpersist()

    return fn


def refine_sliding_top_n(out_path: str, key: str, count: str, size_s: int, slide_s: int, n: int, delay_s: int, rank_col: str = "top_rank"):
    """``refine_top_n`` for sliding windows from counts of panes: a
    ``foreachBatch`` function for an ``update``-mode count per (``key``,
    ``pane``: its start in epoch ms, of ``slide_s``) with ``last_us``, the
    pane's latest time. No row is copied ``size/slide`` times: sums over panes
    are made in the delta form, and windows exist only to be ranked.

    The stream's watermark has a delay of ``delay_s + size_s``, so that a pane
    is counted as long as one of its windows is open; windows that
    ``delay_s`` has closed keep their version. A batch reads earlier panes in
    blocks of ``size_s`` next to its own, by day, and refreshes all open
    windows that meet its blocks.
    """
    size_ms = int(size_s) * 1000
    day, block = F.floor(F.col("pane") / 86_400_000).cast("int"), F.floor(F.col("pane") / size_ms)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        upd = batch.select(key, "pane", count, "last_us").persist()
        before = spark.read.parquet(f"{out_path}-seen/batch_id={batch_id - 1}").first().last_us if batch_id else None
        last = max((t for t in (before, upd.agg(F.max("last_us")).first()[0]) if t is not None), default=None)
        blocks = upd.select(block.alias("block")).distinct()
        panes = upd.select(key, "pane", count)
        if batch_id:
            days = [r[0] for r in upd.select(F.explode(F.sequence(day - 1, day + 1))).distinct().collect()]
            near = blocks.select(F.explode(F.sequence(F.col("block") - 1, F.col("block") + 1)).alias("block")).distinct()
            old = spark.read.parquet(f"{out_path}-panes").where((F.col("batch_id") < batch_id) & F.col("day").isin(days))
            panes = panes.unionByName(old.withColumn("block", block).join(near, "block", "left_semi").select(key, "pane", count))
        panes = panes.groupBy(key, "pane").agg(F.max(count).alias(count)).withColumn("__ts", F.timestamp_millis("pane"))
        counts = sliding_agg_deltas(panes, "__ts", size_s, slide_s, [key], {count: ("sum", count)})
        touched = blocks.select(F.explode(F.array(F.col("block"), F.col("block") - 1)).alias("block")).distinct()
        counts = counts.withColumn("block", F.floor(F.col("window_start") / size_ms)).join(touched, "block", "left_semi")
        if before is not None:
            counts = counts.where(F.col("window_end") > before // 1000 - int(delay_s) * 1000)
        w = Window.partitionBy("window_end").orderBy(F.col(count).desc(), F.col(key))
        ranked = counts.select("window_end", key, count, F.row_number().over(w).cast("bigint").alias(rank_col)).where(F.col(rank_col) <= n)
        (ranked.withColumn("day", F.floor(F.col("window_end") / 86_400_000).cast("int"))
               .write.mode("overwrite").partitionBy("day").parquet(f"{out_path}/batch_id={batch_id}"))
        upd.select(key, "pane", count, day.alias("day")).write.mode("overwrite").partitionBy("day").parquet(f"{out_path}-panes/batch_id={batch_id}")
        spark.range(1).select(F.lit(last).cast("bigint").alias("last_us")).write.mode("overwrite").parquet(f"{out_path}-seen/batch_id={batch_id}")
        upd.unpersist()

    return fn


def latest_top_n(versions: DataFrame, partition: list[str], rank_col: str = "top_rank") -> DataFrame:
    """Newest top-n version of each window from ``refine_top_n`` output."""
    w = Window.partitionBy(*partition)
    return (versions.withColumn("_v", F.max("batch_id").over(w))
                    .where(F.col("batch_id") == F.col("_v")).drop("_v", "batch_id", "day"))
