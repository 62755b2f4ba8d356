"""keyed_scan (bucketed, carry-joined) must equal plain per-key window functions."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.sequence import keyed_scan, shifted


def _data(spark, n=400, keys=3, seed=7):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # one hot key holding most rows, spread over many buckets
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, keys)
        rows.append((i, k, base + timedelta(seconds=rnd.randint(0, 5000)), float(rnd.randint(-5, 5))))
    return spark.createDataFrame(rows, "id long, k long, ts timestamp, v double")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_forward_scan_matches_window(spark):
    df = _data(spark)
    got = keyed_scan(df, ["k"], ["ts", "id"], "ts", split_seconds=300, index="rn",
                     running={"s": ("sum", F.col("v")), "mx": ("max", F.col("v")),
                              "mn": ("min", F.col("v"))},
                     prev=["v", "id"], nxt=["id"], key_first=["id"])
    w = Window.partitionBy("k").orderBy("ts", "id")
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    exp = (df.withColumn("rn", F.row_number().over(w).cast("bigint"))
             .withColumn("s", F.sum("v").over(wr)).withColumn("mx", F.max("v").over(wr))
             .withColumn("mn", F.min("v").over(wr))
             .withColumn("prev_v", F.lag("v").over(w)).withColumn("prev_id", F.lag("id").over(w))
             .withColumn("next_id", F.lead("id").over(w))
             .withColumn("first_id", F.first("id").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    cols = ["id", "rn", "s", "mx", "mn", "prev_v", "prev_id", "next_id", "first_id"]
    assert _rows(got, cols) == _rows(exp, cols)


def test_reverse_scan_is_suffix_aggregate(spark):
    df = _data(spark, seed=11)
    got = keyed_scan(df, ["k"], ["ts", "id"], "ts", split_seconds=200, reverse=True,
                     running={"smin": ("min", F.col("v")), "ssum": ("sum", F.col("v"))})
    w = (Window.partitionBy("k").orderBy("ts", "id")
         .rowsBetween(0, Window.unboundedFollowing))
    exp = df.withColumn("smin", F.min("v").over(w)).withColumn("ssum", F.sum("v").over(w))
    assert _rows(got, ["id", "smin", "ssum"]) == _rows(exp, ["id", "smin", "ssum"])


def test_shifted_matches_lag_k(spark):
    df = _data(spark, seed=3)
    idx = keyed_scan(df, ["k"], ["ts", "id"], "ts", split_seconds=100, index="rn")
    got = shifted(idx, ["k"], "rn", ["id"], 3, "b_")
    w = Window.partitionBy("k").orderBy("ts", "id")
    exp = df.withColumn("b_id", F.lag("id", 3).over(w))
    assert _rows(got, ["id", "b_id"]) == _rows(exp, ["id", "b_id"])


def test_hot_key_is_split_across_partitions(spark):
    """One key holds ~90% of the rows: keyed_scan spreads it over (key, bucket)
    partitions, while a plain per-key window puts it into a single task."""
    base = datetime(2024, 1, 1)
    rows = [(i, 0 if i % 10 else 1 + i % 7, base + timedelta(seconds=i), 1.0) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp, v double")
    # plan as for large data: no partition coalescing, no broadcast of either side
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        def max_share(d):
            # aggregate rn so the window stage is not pruned away
            sizes = (d.groupBy(F.spark_partition_id().alias("p"))
                      .agg(F.count("rn").alias("n"), F.max("rn").alias("m")).collect())
            return max(r["n"] for r in sizes) / 20000

        split = keyed_scan(df, ["k"], ["ts", "id"], "ts", split_seconds=600, index="rn")
        plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
        assert max_share(plain) >= 0.9
        assert max_share(split) < 0.5
        assert sorted(split.select("id", "rn").collect()) == sorted(plain.select("id", "rn").collect())
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
