"""Streaming behaviour: restart without duplicates, update mode, lateness, stream sinks."""

import os
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidepool.sinks.writers import upsert_batch_writer
from tidepool.sources.text import stream_lines_with_origin
from tidepool.streaming.runner import events_stream, read_staged, run_append, run_foreach_batch, scratch, stage_files
from tidepool.streaming.stateful import flat_map_with_state, jump
from tidepool.streaming.windows import stream_window_agg


def _land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    tmp = os.path.join(path, "." + name)
    with open(tmp, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(tmp, os.path.join(path, name))  # atomic landing


def test_lines_with_origin_restart_exactly_once(spark):
    base = scratch(spark, "origin")
    land, out, ck = f"{base}/in", f"{base}/out", f"{base}/ckpt"
    _land(land, "part-0.txt", ["a", "b"])
    run_append(stream_lines_with_origin(spark, land), out, ck)
    _land(land, "part-1.txt", ["c"])
    run_append(stream_lines_with_origin(spark, land), out, ck)   # restart on the same checkpoint
    run_append(stream_lines_with_origin(spark, land), out, ck)   # nothing new
    rows = sorted((r.origin, r.value) for r in spark.read.parquet(out).collect())
    assert rows == [("part-0.txt", "a"), ("part-0.txt", "b"), ("part-1.txt", "c")]


def _stage(spark, base, name, rows):
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double")
    df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    time.sleep(0.05)
    return df.schema


def test_stateful_processor_survives_restart(spark):
    base = scratch(spark, "restart")
    b = datetime(2024, 1, 1)
    schema = _stage(spark, base, "a", [(0, 1, b, 10.0), (1, 1, b + timedelta(seconds=1), 60.0)])

    def run():
        sdf = read_staged(spark, f"{base}/in", schema)
        out = flat_map_with_state(sdf, "user_id", "ts", "event_id", {"value": "double"}, jump(40.0), "value double",
                                  "event_id long, prev_value double, value double")
        run_append(out, f"{base}/out", f"{base}/ckpt")

    run()
    _stage(spark, base, "b", [(2, 1, b + timedelta(seconds=2), 5.0),
                              (3, 1, b + timedelta(seconds=9), 6.0)])
    run()  # the carried previous value (60.0) must come back from the checkpoint
    got = sorted((r.event_id, r.prev_value, r.value) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(1, 10.0, 60.0), (2, 60.0, 5.0)]


def test_update_mode_refines_and_lateness_keeps_window_open(spark):
    """WIN-9 / WIN-10: update mode re-emits a window as rows arrive; a late row
    within the watermark delay still updates its window."""
    base = scratch(spark, "late")
    b = datetime(2024, 1, 1)
    schema = _stage(spark, base, "a", [(0, 1, b + timedelta(seconds=1), 1.0),
                                       (1, 1, b + timedelta(seconds=12), 1.0)])
    _stage(spark, base, "b", [(2, 1, b + timedelta(seconds=3), 1.0),    # late by 9 s, within 60 s
                              (3, 1, b + timedelta(seconds=25), 1.0)])
    sdf = read_staged(spark, f"{base}/in", schema)
    counts = stream_window_agg(sdf, "ts", 10, None, ["user_id"], {"c": ("count", None)}, delay_s=60)
    emitted = []

    def sink(batch, batch_id):
        emitted.extend((batch_id, r.window_start, r.c) for r in batch.collect())

    q = (counts.writeStream.outputMode("update").foreachBatch(sink)
               .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    first = [c for (_, ws, c) in emitted if (ws // 1000) % 60 == 0]
    assert first == [1, 2]   # window [0,10) emitted early, then refined by the late row


def test_stream_upsert_writer(spark, tmp_path):
    out = str(tmp_path / "upserts.log")

    class FileTable:
        def __init__(self):
            self.f = open(out, "a")

        def upsert(self, key, values):
            self.f.write(f"{key}\t{values['value']}\n")

        def close(self):
            self.f.close()

    base = scratch(spark, "upsert")
    b = datetime(2024, 1, 1)
    schema = _stage(spark, base, "a", [(0, 1, b, 1.0), (1, 1, b + timedelta(seconds=1), 2.0),
                                       (2, 2, b, 7.0)])
    sdf = read_staged(spark, f"{base}/in", schema)
    fn = upsert_batch_writer("user_id", ["value"], F.struct("ts", "event_id"), FileTable)
    q = (sdf.writeStream.foreachBatch(fn).option("checkpointLocation", f"{base}/ckpt")
            .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = dict(line.rstrip("\n").split("\t") for line in open(out))
    assert rows == {"1": "2.0", "2": "7.0"}


def test_buffered_processor_orders_late_rows(spark):
    """With a watermark delay, rows arriving out of order (within the delay)
    are still stepped in event order."""
    base = scratch(spark, "buffered")
    b = datetime(2024, 1, 1)
    schema = _stage(spark, base, "a", [(0, 1, b, 10.0), (2, 1, b + timedelta(seconds=5), 100.0)])
    _stage(spark, base, "b", [(1, 1, b + timedelta(seconds=3), 55.0),     # late, inside 10 s delay
                              (3, 1, b + timedelta(seconds=40), 101.0)])
    _stage(spark, base, "c", [(4, 1, b + timedelta(seconds=90), 0.0)])
    sdf = read_staged(spark, f"{base}/in", schema)
    out = flat_map_with_state(sdf, "user_id", "ts", "event_id", {"value": "double"}, jump(40.0), "value double",
                              "event_id long, prev_value double, value double", delay_s=10)
    run_append(out, f"{base}/out", f"{base}/ckpt")
    got = sorted((r.event_id, r.prev_value, r.value) for r in spark.read.parquet(f"{base}/out").collect())
    # event order 0 (10) -> 1 (55) -> 2 (100) -> 3 (101): jumps at 1 and 2; row 4 is past the watermark
    assert got == [(1, 10.0, 55.0), (2, 55.0, 100.0)]


def test_top_n_refined_by_late_rows(spark):
    """TOP-2: a late row (within the lateness) changes an already emitted ranking."""
    from tidepool.streaming.windows import latest_top_n, refine_top_n

    base = scratch(spark, "refine")
    b = datetime(2024, 1, 1)
    rows_a = [(0, 1, b + timedelta(seconds=1), 1.0), (1, 2, b + timedelta(seconds=2), 1.0),
              (2, 2, b + timedelta(seconds=3), 1.0), (3, 9, b + timedelta(seconds=15), 1.0)]
    schema = _stage(spark, base, "a", rows_a)
    # late rows for window [0,10): item 1 overtakes item 2
    _stage(spark, base, "b", [(4, 1, b + timedelta(seconds=4), 1.0), (5, 1, b + timedelta(seconds=5), 1.0),
                              (6, 9, b + timedelta(seconds=18), 1.0)])
    sdf = read_staged(spark, f"{base}/in", schema).withColumnRenamed("user_id", "item")
    counts = (sdf.withWatermark("ts", "60 seconds")
                 .groupBy("item", F.window("ts", "10 seconds").alias("w"))
                 .agg(F.count(F.lit(1)).alias("c"))
                 .select("item", F.unix_millis("w.end").alias("window_end"), "c"))
    q = (counts.writeStream.outputMode("update")
               .foreachBatch(refine_top_n(f"{base}/out", ["window_end"], "item", "c", 1))
               .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    versions = spark.read.parquet(f"{base}/out")
    first = min(r.window_end for r in versions.collect())
    history = sorted((r.batch_id, r.item, r.c) for r in versions.where(F.col("window_end") == first).collect())
    assert history[0][1:] == (2, 2) and history[-1][1:] == (1, 3)
    final = {r.window_end: (r.item, r.c) for r in latest_top_n(versions, ["window_end"]).collect()}
    assert final[first] == (1, 3)


def test_staging_orders_by_arrival_and_happens_once(spark):
    base = scratch(spark, "stage")
    b = datetime(2024, 1, 1)
    rows = [(i, i % 3, b + timedelta(seconds=(i * 37) % 500), float(i)) for i in range(300)]
    df = spark.createDataFrame([*rows, (999, 1, None, 0.0)], "event_id long, user_id long, ts timestamp, value double")
    n_files = stage_files(df, f"{base}/in", "ts", close=True)
    first = sorted(r.f for r in spark.read.parquet(f"{base}/in").select(F.input_file_name().alias("f")).distinct().collect())
    assert stage_files(df, f"{base}/in", "ts", close=True) == n_files  # nothing is written again
    assert first == sorted(r.f for r in spark.read.parquet(f"{base}/in").select(F.input_file_name().alias("f")).distinct().collect())
    seen = []
    run_foreach_batch(read_staged(spark, f"{base}/in", df.schema, n_files),
                      lambda batch, k: seen.append([(r.ts, r.event_id) for r in batch.collect()]), f"{base}/ckpt")
    known = [[t for t, _ in part if t] for part in seen]
    assert all(max(a) <= min(z) for a, z in zip(known, known[1:]) if a and z)
    assert sum(map(len, seen)) == 302 and seen[-1][-1][0] > b + timedelta(days=3000)


def test_a_resumed_run_counts_nothing_twice(spark, sf_small):
    from tidepool.plans.catalog import QUERIES

    spark.conf.set("spark.tidepool.stream.run", "again")
    try:
        first = sorted(tuple(r) for r in QUERIES["stream_running_count"](spark, sf_small).collect())
        again = sorted(tuple(r) for r in QUERIES["stream_running_count"](spark, sf_small).collect())
    finally:
        spark.conf.unset("spark.tidepool.stream.run")
    assert first == again and sum(n for _, n in first) == 1000


def test_an_interrupted_run_continues(spark, sf_small):
    """The first run dies in its third batch; the second takes up from there."""
    spark.conf.set("spark.tidepool.stream.run", "broken")
    try:
        done = []

        def run(dies: bool):
            sdf, base = events_stream(spark, sf_small, "interrupted")

            def sink(batch, k):
                if dies and k == 2:
                    raise RuntimeError("lost")
                batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={k}")
                done.append(k)

            run_foreach_batch(sdf, sink, f"{base}/ckpt")
            return base

        try:
            run(True)
            raise AssertionError("it should have died")
        except Exception as e:
            assert "lost" in str(e)
        base = run(False)
    finally:
        spark.conf.unset("spark.tidepool.stream.run")
    assert done == sorted(set(done))
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == out.select("event_id").distinct().count() == 1000


def test_nulls_on_streams_count_as_in_batches(spark):
    from tidepool.operators.windows import window_agg

    base = scratch(spark, "nulls")
    b = datetime(2024, 1, 1)
    rows = [(i, 1, b + timedelta(seconds=i), None if i % 3 == 0 else float(i)) for i in range(10)]
    schema = _stage(spark, base, "a", rows)
    _stage(spark, base, "b", [(99, -1, b + timedelta(days=9), None)])
    sdf = read_staged(spark, f"{base}/in", schema)
    m = {"n": ("count", None), "known": ("count", "value"), "total": ("sum", "value")}
    run_append(stream_window_agg(sdf, "ts", 60, None, ["user_id"], m, panes=False), f"{base}/out", f"{base}/ckpt")
    got = [tuple(r) for r in spark.read.parquet(f"{base}/out").where("user_id = 1").select("n", "known", "total").collect()]
    batch = window_agg(spark.read.parquet(f"{base}/in").where("user_id = 1"), "ts", 60, None, ["user_id"], m)
    assert got == [tuple(r) for r in batch.select("n", "known", "total").collect()] == [(10, 6, 27.0)]


def test_state_machines_skip_nulls():
    from tidepool.streaming.stateful import CountWindowProcessor, RisingProcessor, SlidingCountProcessor

    def run(p, values):
        carry, out = None, []
        for i, v in enumerate(values):
            carry, got = p.step((1,), carry, (i * 1_000_000, i, v))
            out += got
        return out

    assert run(CountWindowProcessor(3), [None, 5.0, 2.0]) == [(1, 1, 2.0)]
    assert run(SlidingCountProcessor(2, 2), [None, None, 1.0, None]) == [(1, 2, None), (1, 4, 1.0)]
    assert run(RisingProcessor(1), [1.0, 2.0, None, 9.0, 9.0]) == [(1, 1000, 2000)]


def test_click_count_is_forgotten_after_its_day():
    from tidepool.streaming.stateful import ClickCapProcessor

    p = ClickCapProcessor(2)
    carry, _ = p.step((1, 7), None, (5, 1, 0))
    assert p.deadline_us(carry) == 86_400_000_000
    assert p.on_watermark((1, 7), carry, 86_399_000_000)[0] == carry
    assert p.on_watermark((1, 7), carry, 86_400_000_000)[0] is None


def test_sequence_on_a_stream_equals_batch(spark):
    """Three steps, rows out of order within the delay, restart in the middle, timeouts by the watermark."""
    from tidepool.operators.patterns import Step, sequence
    from tidepool.streaming.stateful import sequence_stream

    steps = [Step("a", F.col("value") < 3), Step("b", F.col("value") > 6, strict=True), Step("c", F.col("value") == 5.0)]
    base = scratch(spark, "seq")
    b = datetime(2024, 1, 1)
    rows = [(i, i % 3, b + timedelta(seconds=i + (7 * i) % 5), float((i * i) % 10)) for i in range(200)]
    end = [(999 + u, u, b + timedelta(days=9 + u), 4.0) for u in range(3)]
    late = [end[-1][:2] + (b + timedelta(days=30), 4.0)]

    def run():
        found = sequence_stream(read_staged(spark, f"{base}/in", schema), "user_id", "ts", "event_id", steps, 60, delay_s=10)
        run_append(found, f"{base}/out", f"{base}/ckpt")

    schema = _stage(spark, base, "a", rows[:80])
    run()
    for part in (rows[80:140], rows[140:], end, late):
        _stage(spark, base, "b", part)
        run()
    names = ["a", "b", "c"]
    got = sorted(((r.user_id, r.status, *[r[n].event_id if r[n] else None for n in names]) for r in spark.read.parquet(f"{base}/out").collect()), key=str)
    df = spark.createDataFrame(rows + end, schema)
    want = sorted(((r.user_id, r.status, *[r[n].event_id if r[n] else None for n in names])
                   for r in sequence(df, ["user_id"], ["ts", "event_id"], "ts", steps, 60, ["event_id"]).collect()), key=str)
    assert got == want and {"matched", "timeout"} <= {r[1] for r in got}


def test_python_is_called_for_a_bucket_not_for_a_key(spark, tmp_path):
    """300 keys, one of them NULL, in 4 buckets: at most 4 calls a batch; every key has its own state over batches."""
    from tidepool.streaming.stateful import EveryNthProcessor, run_ordered

    log = str(tmp_path / "calls")

    class Noted(EveryNthProcessor):
        def handleInputRows(self, key, rows, timerValues):
            with open(log, "a") as f:
                f.write("x")
            yield from super().handleInputRows(key, rows, timerValues)

    base = scratch(spark, "buckets")
    b = datetime(2024, 1, 1)
    big = 1 << 60
    rows = [(i, None if i % 300 == 7 else big + i % 300, b + timedelta(seconds=i), float(i)) for i in range(1500)]
    for part in (rows[:700], rows[700:]):
        schema = _stage(spark, base, "a", part)
    out = run_ordered(read_staged(spark, f"{base}/in", schema), "user_id", "ts", "event_id", ["value"], Noted(2),
                      "user_id long, event_id long, row_no long", buckets=4)
    run_append(out, f"{base}/out", f"{base}/ckpt")
    got = sorted((r.event_id, r.user_id, r.row_no) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(i, u, i // 300 + 1) for i, u, _, _ in rows if i // 300 % 2]
    assert len(open(log).read()) <= 4 * 3


def test_sliding_top_n_is_refined_from_panes(spark):
    """Late rows, ties, several batches: the last version of every window is the exact ranking; no row is copied to its windows in the state."""
    import random

    from tidepool.streaming.windows import latest_top_n, refine_sliding_top_n

    r, b, base = random.Random(5), datetime(2024, 1, 1, 23, 58), scratch(spark, "panes")
    rows = [(i, r.randint(0, 6), b + timedelta(seconds=i // 4 - r.choice((0, 0, 7, 19))), 1.0) for i in range(1600)]
    for part in (rows[:500], rows[500:1100], rows[1100:]):
        schema = _stage(spark, base, "a", part)
    sdf = read_staged(spark, f"{base}/in", schema).withColumnRenamed("user_id", "item")
    panes = (sdf.withWatermark("ts", "80 seconds").groupBy("item", F.window("ts", "5 seconds").alias("w"))
                .agg(F.count(F.lit(1)).alias("c"), F.max(F.unix_micros("ts")).alias("last_us"))
                .select("item", F.unix_millis("w.start").alias("pane"), "c", "last_us"))
    progress = run_foreach_batch(panes, refine_sliding_top_n(f"{base}/out", "item", "c", 60, 5, 2, 20), f"{base}/ckpt", mode="update")
    counts = {}
    for _, item, t, _ in rows:
        s = int((t - datetime(1970, 1, 1)).total_seconds()) // 5 * 5
        for start in range(s - 55, s + 5, 5):
            at = counts.setdefault((start + 60) * 1000, {})
            at[item] = at.get(item, 0) + 1
    want = sorted((end, item, n, k) for end, at in counts.items()
                  for k, (n, item) in enumerate(sorted(((-n, i) for i, n in at.items()))[:2], 1) for n in [-n])
    versions = spark.read.parquet(f"{base}/out")
    assert sorted(tuple(x) for x in latest_top_n(versions, ["window_end"]).select("window_end", "item", "c", "top_rank").collect()) == want
    assert versions.select("batch_id").distinct().count() == 3
    assert sum(op["numRowsUpdated"] for p in progress for op in p["stateOperators"]) <= len(rows)
