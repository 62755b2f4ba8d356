"""Window operators: pane rewrite equals the direct form; count windows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidepool.operators.windows import (count_window, session_agg, sliding_count_window,
                                        window_agg)
from tidepool.sources.tables import load_events


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pane_equals_direct(spark, sf_small):
    ev = load_events(spark, sf_small)
    for size, slide, keys in ((3600, 300, ["item_id"]), (600, 5, ["user_id"]), (10, 3, ["user_id"])):
        m = {"c": ("count", None), "mn": ("min", "value"), "mx": ("max", "value")}
        _same(window_agg(ev, "ts", size, slide, keys, m, panes=True),
              window_agg(ev, "ts", size, slide, keys, m, panes=False))


def test_deltas_equal_direct(spark, sf_small):
    from tidepool.operators.windows import sliding_agg_deltas

    ev = load_events(spark, sf_small)
    for size, slide, keys in ((3600, 300, ["item_id"]), (600, 5, ["user_id"]), (10, 3, []),
                              (3600, 10, ["event_type"])):
        m = {"c": ("count", None), "s": ("sum", "value")}
        a = window_agg(ev, "ts", size, slide, keys, m, method="direct").withColumn("s", F.round("s", 6))
        b = sliding_agg_deltas(ev, "ts", size, slide, keys, m).withColumn("s", F.round("s", 6))
        _same(a, b)


def test_sliding_window_membership(spark):
    t = datetime(2024, 1, 1, 0, 0, 7)
    df = spark.createDataFrame([(1, t)], "k long, ts timestamp")
    w = window_agg(df, "ts", 10, 3, ["k"]).orderBy("window_start").collect()
    starts = [(r.window_start // 1000) % 100 for r in w]
    # 00:00:07 lies in [0,10), [3,13), [6,16) with 3 s slides (epoch aligned)
    assert starts == [0, 3, 6]
    assert all(r.window_end - r.window_start == 10_000 for r in w)


def _seq(spark, values):
    base = datetime(2024, 1, 1)
    rows = [(i, 1, base + timedelta(seconds=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double")


def test_count_window_drops_incomplete_tail(spark):
    df = _seq(spark, [5, 4, 3, 2, 1, 9, 8, 7, 6, 0, 1, 1])
    r = count_window(df, "user_id", ["ts", "event_id"], "ts", 5,
                     {"mn": ("min", "value")}).orderBy("window_no").collect()
    assert [(x.window_no, x.mn) for x in r] == [(1, 1.0), (2, 0.0)]


def test_sliding_count_window(spark):
    df = _seq(spark, range(1, 13))
    r = sliding_count_window(df, "user_id", ["ts", "event_id"], "ts", 10, 2, "value")
    got = {x.row_no: x.sum_value for x in r.collect()}
    assert got == {2: 3.0, 4: 10.0, 6: 21.0, 8: 36.0, 10: 55.0, 12: sum(range(3, 13))}


def test_session_gap(spark):
    base = datetime(2024, 1, 1)
    rows = [(1, base), (1, base + timedelta(seconds=5)), (1, base + timedelta(seconds=30))]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp")
    r = session_agg(df, "ts", "user_id", 10).orderBy("session_start").collect()
    assert [x.cnt for x in r] == [2, 1]
    assert r[0].session_end - r[0].session_start == 15_000


def test_sessions_equal_the_built_in_ones_with_a_hot_key(spark):
    import random

    r, b = random.Random(9), datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        key = 0 if r.random() < 0.7 else r.randint(1, 5)
        # the hot key has one endless session over many segments, and ties
        at = i * 7 if key == 0 else r.randint(0, 20_000) // 10 * 10
        rows.append((i, None if i % 90 == 4 else key, None if i % 100 == 9 else b + timedelta(seconds=at), float(i % 13) if i % 11 else None))
    df = spark.createDataFrame(rows, "id long, user_id long, ts timestamp, v double")
    m = {"cnt": ("count", None), "known": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v")}
    for gap, split in ((30, 100), (60, 600), (10, 3600)):
        got = session_agg(df, "ts", "user_id", gap, m, split_seconds=split)
        want = (df.where("ts IS NOT NULL").groupBy("user_id", F.session_window("ts", f"{gap} seconds").alias("s"))
                .agg(F.count(F.lit(1)).alias("cnt"), F.count("v").alias("known"), F.sum("v").alias("total"), F.min("v").alias("low"))
                .select("user_id", F.unix_millis("s.start").alias("session_start"), F.unix_millis("s.end").alias("session_end"), "cnt", "known", "total", "low"))
        _same(got, want)


def test_sessions_read_once_and_never_deal_by_key_alone(spark, sf_small):
    got = session_agg(load_events(spark, sf_small), "ts", "user_id", 3600)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    big = [line for line in plan.splitlines() if "hashpartitioning(_key" in line and "REPARTITION_BY_COL" in line]
    assert big and all("__ks_b" in line for line in big)


def test_sketches_of_panes_merge_into_windows(spark):
    """20,000 users: the estimate is within 5 % of the exact count, in tumbling and sliding windows."""
    from tidepool.operators.distinct import uv_from_sketches, uv_sketches

    df = spark.range(60_000).select(F.timestamp_seconds(1_704_067_200 + F.col("id") % 7200).alias("ts"), F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("user_id"))
    df = df.unionByName(spark.createDataFrame([(None, 1), (datetime(2024, 1, 1), None)], "ts timestamp, user_id long"))
    panes = uv_sketches(df, "ts", "user_id", 600)
    assert panes.count() == 12
    for size, slide in ((3600, None), (3600, 600)):
        got = {r.window_end: r.uv_sketch for r in uv_from_sketches(panes, size, slide).collect()}
        want = {r.window_end: r.n for r in window_agg(df.where("ts IS NOT NULL"), "ts", size, slide, [], {"u": ("count", None)}, panes=False).select("window_end", F.lit(0).alias("n")).collect()}
        exact = {}
        for end in want:
            inside = df.where((F.unix_millis("ts") >= end - size * 1000) & (F.unix_millis("ts") < end))
            exact[end] = inside.select("user_id").where("user_id IS NOT NULL").distinct().count()
        assert got.keys() == exact.keys()
        assert all(abs(got[e] - exact[e]) <= 0.05 * exact[e] + 1 for e in exact)
