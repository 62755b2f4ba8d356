"""No value, key or row is lost to a default, a NULL or a method."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.functions.text import normalize_int
from tidepool.operators.aggregates import payment_totals, running_count
from tidepool.operators.windows import window_agg
from tidepool.sinks.writers import print_sink
from tidepool.streaming.stateful import RunningSumProcessor, WindowRunningCountProcessor

T0 = dt.datetime(2024, 1, 1)


def test_null_measures_agree_across_methods(spark):
    rows = [(1, T0 + dt.timedelta(seconds=s), v) for s, v in ((0, 1.0), (3, None), (20, None), (21, None), (33, 2.5))]
    df = spark.createDataFrame(rows, "k long, ts timestamp, v double")
    measures = {"n": ("count", None), "c": ("count", "v"), "s": ("sum", "v")}
    got = [sorted(map(tuple, window_agg(df, "ts", 10, 5, ["k"], measures, method=m).collect())) for m in ("deltas", "panes", "direct")]
    assert got[0] == got[1] == got[2]
    assert (1, 1704067220000, 1704067230000, 2, 0, None) in got[0]


def test_null_keys_and_times_stay(spark):
    df = spark.createDataFrame([(1, T0, 1), (None, T0, 2), (None, T0 + dt.timedelta(hours=5), 3), (1, None, 4)], "k long, ts timestamp, id long")
    got = {(r.id, r.running_count) for r in running_count(df, "k", ["ts", "id"], "ts").collect()}
    assert got == {(1, 2), (2, 1), (3, 2), (4, 1)}


def test_money_keeps_its_digits(spark):
    df = spark.createDataFrame([("a", 0.004), ("b", 0.004), ("c", 2e10)], "id string, fee double")
    r = payment_totals(df.where("id <> 'c'"), F.lit(True), F.col("fee"), F.struct("id"), "id").first()
    assert r.success_money == 0.008
    assert payment_totals(df, F.lit(True), F.col("fee"), F.struct("id"), "id").first().success_money == 20000000000.008


def test_running_sum_is_exact():
    p, carry, out = RunningSumProcessor(), None, []
    for i, v in enumerate((0.004, 0.004, None, 0.1)):
        carry, got = p.step((1,), carry, (i, i, v))
        out += [x[2] for x in got]
    assert out == [0.004, 0.008, 0.008, 0.108]


def test_closed_windows_leave_no_state():
    p = WindowRunningCountProcessor(60, 20)  # three windows hold a row
    counts, out = p.step((1,), p.load(None), (65_000_000, 7, None))
    assert [(r[1], r[3], r[4]) for r in out] == [(60_000, 120_000, 1), (40_000, 100_000, 1), (20_000, 80_000, 1)]
    counts, out = p.step((1,), counts, (80_000_000, 8, None))  # the window up to 80 s is over
    assert sorted((r[1], r[4]) for r in out) == [(40_000, 2), (60_000, 2), (80_000, 1)]
    assert p.load(p.save(counts)) == counts and p.deadline_us(counts) == 140_000_000
    assert p.on_watermark((1,), counts, 119_000_000)[0] == {60_000_000: 2, 80_000_000: 1}
    assert p.save(p.on_watermark((1,), counts, 140_000_000)[0]) is None


def test_every_row_is_printed(spark, tmp_path):
    print_sink(spark.range(57), "row", str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(lines) == 57 and 'row> {"id":41}' in lines


def test_malformed_integers_are_errors(spark):
    df = spark.createDataFrame([("3000000000",), (" 007 ",)], "t string")
    assert [r[0] for r in df.select(normalize_int("t", lenient=False)).collect()] == ["3000000000", "7"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("abc",)], "t string").select(normalize_int("t", lenient=False)).collect()
