"""Sinks with commit and abort, replayed batches, headers, dropped rows."""

import os
from datetime import datetime, timedelta

import pytest

from tidepool.plans.catalog import QUERIES
from tidepool.sinks.datasource import FileTarget, target_format
from tidepool.sources.kafka import drop_replayed, header_value, kafka_records, kafka_sink, with_record_headers
from tidepool.streaming.runner import observed, read_staged, rows_dropped, run_append, scratch

B = datetime(2024, 1, 1)


def _land(spark, path, rows):
    df = spark.createDataFrame(rows, "key string, value string, ts timestamp")
    df.repartition(2).write.mode("append").parquet(path)
    return df.schema


def _stream(spark, base, schema, target):
    fmt = target_format(spark, f"t{abs(hash(base))}", target)
    q = (read_staged(spark, f"{base}/in", schema).select("key", "value").writeStream.format(fmt)
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()


def test_a_replayed_batch_gives_no_second_copy(spark, tmp_path):
    base = str(tmp_path)
    target = FileTarget(f"{base}/out")
    schema = _land(spark, f"{base}/in", [(str(i), "a", B) for i in range(5)])
    _stream(spark, base, schema, target)
    assert target.read(spark, "key string, value string").count() == 5
    last = max(int(n) for n in os.listdir(f"{base}/ckpt/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):  # the query died after the target's commit, before its own
        if os.path.exists(f"{base}/ckpt/commits/{name}"):
            os.unlink(f"{base}/ckpt/commits/{name}")
    _stream(spark, base, schema, target)
    _land(spark, f"{base}/in", [("9", "b", B)])
    _stream(spark, base, schema, target)
    got = sorted((r.key, r.value) for r in target.read(spark, "key string, value string").collect())
    assert got == [(str(i), "a") for i in range(5)] + [("9", "b")]
    assert len(os.listdir(f"{base}/out/rows")) == len(target.files())  # the replay's files are gone


def test_a_failed_write_shows_nothing(spark, tmp_path):
    class FailsOnce(FileTarget):
        def stage(self, rows):
            held = list(rows)
            token = super().stage(iter(held))
            if any(r["key"] == "bad" for r in held):
                raise OSError("lost")
            return token

    target = FailsOnce(str(tmp_path / "out"))
    fmt = target_format(spark, "fails_once", target)
    rows = spark.createDataFrame([("good", 1), ("bad", 2), ("fine", 3)], "key string, n int").repartition(3)
    with pytest.raises(Exception, match="lost"):
        rows.write.format(fmt).mode("append").save()
    assert target.files() == []
    rows.where("key <> 'bad'").write.format(fmt).mode("append").save()
    assert sorted(r.key for r in target.read(spark, "key string, n int").collect()) == ["fine", "good"]


def test_target_needs_a_shared_file_system():
    assert FileTarget("file:///tmp/x").path == "/tmp/x"
    with pytest.raises(ValueError):
        FileTarget("s3://bucket/x")


def test_nothing_written_is_an_empty_table(spark, tmp_path):
    target = FileTarget(str(tmp_path / "none"))
    assert target.read(spark, "a string").count() == 0
    spark.range(0).selectExpr("cast(id as string) AS a").write.format(target_format(spark, "none_written", target)).mode("append").save()
    assert target.read(spark, "a string").count() == 0


def test_topic_sink_takes_another_format(spark, tmp_path):
    """SNK-2: the writer of a topic, here with a file-backed target."""
    base = str(tmp_path)
    target = FileTarget(f"{base}/topic")
    schema = _land(spark, f"{base}/in", [("1", "x", B), ("2", None, B)])
    records = kafka_records(read_staged(spark, f"{base}/in", schema), "value", "key")
    q = kafka_sink(records, "t", "host:9092", f"{base}/ckpt", fmt=target_format(spark, "topic_files", target)).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.key, r.value) for r in target.read(spark, "key string, value string").collect()) == [("1", "x"), ("2", None)]


def test_headers_are_the_same_when_a_batch_is_replayed(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), (None, None)], "key string, value string")
    named = lambda d: sorted((header_value_of(r, "batch_id"), header_value_of(r, "row_id")) for r in d.collect())

    def header_value_of(r, name):
        return next(bytes(h.value).decode() for h in r.headers if h.key == name)

    first, again = with_record_headers(df, 3), with_record_headers(df.repartition(3), 3)
    assert named(first) == named(again) and len(set(named(first))) == 4  # equal rows have numbers of their own
    assert first.columns == ["key", "value", "headers"]
    by_key = with_record_headers(df, 3, ["key"])
    assert len(set(named(by_key))) == 3
    assert by_key.select(header_value("batch_id").alias("b")).distinct().collect()[0].b == "3"


def test_reader_drops_replays_within_the_bound_only(spark):
    base = scratch(spark, "replays")
    rows = [(str(i), "v", B + timedelta(seconds=i)) for i in range(6)]
    df = spark.createDataFrame(rows, "key string, value string, ts timestamp")
    for batch_id, part in ((0, rows[:3]), (1, rows[3:]), (0, rows[:3]), (1, rows[3:])):
        d = spark.createDataFrame(part, df.schema)
        with_record_headers(d, batch_id, ["key"]).coalesce(1).write.mode("append").parquet(f"{base}/topic")
    schema = spark.read.parquet(f"{base}/topic").schema
    run_append(drop_replayed(read_staged(spark, f"{base}/topic", schema), "ts", 60).select("key"), f"{base}/out", f"{base}/ckpt")
    assert sorted(r.key for r in spark.read.parquet(f"{base}/out").collect()) == [str(i) for i in range(6)]


def test_dropped_and_read_rows_are_reported(spark, sf_small):
    rows = QUERIES["stream_late_dropped"](spark, sf_small).collect()
    assert rows[0].rows_dropped > 0  # rows beyond the delay are lost, and said to be
    assert sum(r.pv for r in rows) + rows[0].rows_dropped == rows[0].rows_read


def test_progress_sums():
    progress = [{"batchId": 0, "stateOperators": [{"numRowsDroppedByWatermark": 2}, {}], "observedMetrics": {"m": {"rows": 5}}},
                {"batchId": 1, "stateOperators": [{"numRowsDroppedByWatermark": 1}]}, {"batchId": 2}]
    assert rows_dropped(progress) == 3 and observed(progress, "m", "rows") == 5


def test_the_daily_cap_bites(spark, sf_small):
    kinds = [r.kind for r in QUERIES["click_cap_daily"](spark, sf_small).select("kind").collect()]
    assert kinds.count("pass") > 0 and len(kinds) > kinds.count("pass")
