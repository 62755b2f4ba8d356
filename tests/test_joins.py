"""Bucketed interval join vs a brute-force band join; reconcile partitions rows."""

from pyspark.sql import functions as F

from tidepool.operators.joins import interval_join, lookup, reconcile
from tidepool.sources.tables import load_events


def _sides(spark, sf):
    ev = load_events(spark, sf)
    p = ev.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("pid"), F.col("ts").alias("pts"))
    c = ev.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("cid"), F.col("ts").alias("cts"))
    return p, c


def test_interval_join_equals_brute_force(spark, sf_small):
    p, c = _sides(spark, sf_small)
    for lower, upper, bucket in ((3600, 3600, None), (7200, 600, 900), (0, 86400, 3600)):
        got = interval_join(p, c, "user_id", "pts", "cts", lower, upper, bucket).select("pid", "cid")
        cond = ((p.user_id == c.user_id)
                & (F.unix_micros(c.cts) >= F.unix_micros(p.pts) - lower * 10**6)
                & (F.unix_micros(c.cts) <= F.unix_micros(p.pts) + upper * 10**6))
        exp = p.join(c, cond).select("pid", "cid")
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_reconcile_partitions_both_sides(spark, sf_small):
    p, c = _sides(spark, sf_small)
    r = reconcile(p, c, "user_id", "pts", "cts", "pid", "cid", 86400, 86400)
    matched_p = r.where("tag = 'matched'").select("pid").distinct().count()
    assert matched_p + r.where("tag = 'unmatched_left'").count() == p.count()
    matched_c = r.where("tag = 'matched'").select("cid").distinct().count()
    assert matched_c + r.where("tag = 'unmatched_right'").count() == c.count()


def test_lookup_first_match_case_insensitive(spark):
    left = spark.createDataFrame([("zhagnsan", 1356.67), ("LISI", 1476.67), ("wangwu", 1.0)],
                                 "name string, salary double")
    small = spark.createDataFrame([(0, "Zhagnsan", 4), (1, "lisi", 5), (2, "lisi", 9)],
                                  "pos int, name string, month int")
    r = {x.name: x.month for x in lookup(left, small, "name", "name", ["month"], "pos").collect()}
    assert r == {"zhagnsan": 4, "LISI": 5, "wangwu": None}


def _hot(spark, seed, hot_left, hot_right, n=300):
    """Two sides; one key (and one hour of it) may hold most rows of either, with equal times and NULLs."""
    import random
    from datetime import datetime, timedelta

    r, b = random.Random(seed), datetime(2024, 1, 1)

    def side(hot, first):
        rows = []
        for i in range(n):
            key = 0 if r.random() < hot else r.randint(1, 30)
            at = r.randint(0, 3600) if key == 0 else r.randint(0, 40_000)
            rows.append((first + i, None if i % 60 == 3 else key, None if i % 70 == 5 else b + timedelta(seconds=at // 10 * 10)))
        return rows

    left = spark.createDataFrame(side(hot_left, 0), "lid long, k long, lts timestamp")
    right = spark.createDataFrame(side(hot_right, 1000), "rid long, k long, rts timestamp")
    return left, right


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_reconcile_with_a_hot_key_on_either_side(spark):
    for seed, hot_left, hot_right, lower, upper in ((1, 0.9, 0.0, 60, 300), (2, 0.0, 0.9, 300, 60), (3, 0.7, 0.7, 30, 30), (4, 0.0, 0.0, 0, 0)):
        left, right = _hot(spark, seed, hot_left, hot_right)
        got = reconcile(left, right, "k", "lts", "rts", "lid", "rid", lower, upper)
        gap = F.unix_micros("rts") - F.unix_micros("lts")
        right2 = right.withColumnRenamed("k", "k2")
        full = left.join(right2, (F.col("k") == F.col("k2")) & (gap >= -lower * 10**6) & (gap <= upper * 10**6), "full_outer")
        tag = (F.when(F.col("lid").isNotNull() & F.col("rid").isNotNull(), "matched").when(F.col("lid").isNull(), "unmatched_right")
               .otherwise("unmatched_left"))
        want = full.select(tag.alias("tag"), F.coalesce("k", "k2").alias("k"), "lid", "rid")
        assert _rows(got, ["tag", "k", "lid", "rid"]) == _rows(want, ["tag", "k", "lid", "rid"]), seed


def test_left_window_join_with_a_hot_key_on_either_side(spark):
    from tidepool.operators.joins import window_join

    for seed, hot_left, hot_right in ((5, 0.9, 0.0), (6, 0.0, 0.9), (7, 0.6, 0.6)):
        left, right = _hot(spark, seed, hot_left, hot_right, 200)
        got = window_join(left, right, "k", "lts", "rts", 600, "left")
        b = lambda c: F.floor(F.unix_seconds(c) / 600)
        want = left.join(right.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (b("lts") == b("rts")), "left")
        assert _rows(got, ["lid", "rid", "k"]) == _rows(want, ["lid", "rid", "k"])


def test_no_outer_join_is_left_to_a_hot_key(spark):
    left, right = _hot(spark, 8, 0.9, 0.9)
    plan = reconcile(left, right, "k", "lts", "rts", "lid", "rid", 60, 60)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftOuter" not in plan
