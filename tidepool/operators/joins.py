"""Joins (JN-1..5).

Interval joins are equi-joins on ``(key, time bucket)`` plus the band
predicate: the left side lists the few buckets its band touches, the right
side keeps its single bucket. Only rows in neighbouring buckets are compared,
never all pairs of a key, and AQE's skew-join splits a hot ``(key, bucket)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.sequence import deal, dealt_scan

US = 1_000_000


def _bucket_bounds(t_us: Column, lower_us: int, upper_us: int, width_us: int):
    return _bucket(t_us - F.lit(lower_us), width_us), _bucket(t_us + F.lit(upper_us), width_us)


def _bucket(t_us: Column, width_us: int) -> Column:
    """``floor(t / width)`` in exact integer math."""
    w = F.lit(int(width_us)).cast("bigint")
    return (t_us - F.pmod(t_us, w)) / w


def interval_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str,
                  lower_s: int, upper_s: int, bucket_s: int | None = None) -> DataFrame:
    """JN-1: pairs with equal ``key`` and ``right.ts in [left.ts - lower, left.ts + upper]``
    (inclusive). Inner, all qualifying pairs. Columns of both sides are kept;
    ``right`` columns must not collide with ``left`` ones except ``key``.
    """
    width = int(bucket_s or max(lower_s, upper_s, 1)) * US
    lt, rt = F.unix_micros(F.col(lts)), F.unix_micros(F.col(rts))
    lo, hi = _bucket_bounds(lt, lower_s * US, upper_s * US, width)
    l2 = left.withColumn("_lt", lt).withColumn(
        "_jb", F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint"))))
    r2 = right.withColumn("_rt", rt).withColumn("_jb", _bucket(rt, width).cast("bigint"))
    j = l2.join(r2, on=[key, "_jb"], how="inner")
    j = j.where((F.col("_rt") >= F.col("_lt") - lower_s * US) & (F.col("_rt") <= F.col("_lt") + upper_s * US))
    return j.drop("_jb", "_lt", "_rt")


def reconcile(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, lid: str, rid: str,
              lower_s: int, upper_s: int, bucket_s: int | None = None) -> DataFrame:
    """JN-2: matched pairs plus the unmatched rows of each side, tagged. Rows
    without a key or a time match nothing.

    Pairs come from the bucketed inner join, in which AQE splits a hot (key,
    bucket) on either side (it can split neither side of a full outer join).
    Whether a row is unmatched needs no join: a left row has a partner if the
    other side's nearest row in time, before or after it, lies in its band. One
    skew-safe scan over both sides tells every row its nearest neighbours, so a
    hot key is never in one task and no row is copied.
    """
    pairs = interval_join(left.select(key, lid, F.col(lts).alias("_lts")), right.select(key, rid, F.col(rts).alias("_rts")),
                          key, "_lts", "_rts", lower_s, upper_s, bucket_s)
    none = F.lit(None)
    both = left.select(F.col(key), F.col(lts).alias("_ts"), F.col(lid), none.cast(right.schema[rid].dataType).alias(rid), F.lit(True).alias("_left")).unionByName(
        right.select(F.col(key), F.col(rts).alias("_ts"), none.cast(left.schema[lid].dataType).alias(lid), F.col(rid), F.lit(False).alias("_left")))
    t = F.unix_micros("_ts")
    d = deal(both.withColumn("_t", t), [key], "_ts")
    other = {"l": F.when(F.col("_left"), F.col("_t")), "r": F.when(~F.col("_left"), F.col("_t"))}
    # rows of one time see each other: those of the other side count as before and as after
    for order, suffix in ((["_ts", "_left"], "a"), (["_ts", "_right"], "b")):
        d = dealt_scan(d.withColumn("_right", ~F.col("_left")), [key], order,
                       running={f"_before_{s}{suffix}": ("max", c) for s, c in other.items()})
        d = dealt_scan(d, [key], order, reverse=True, running={f"_after_{s}{suffix}": ("min", c) for s, c in other.items()})

    def near(side: str, back_s: int, ahead_s: int) -> Column:
        last = F.greatest(F.col(f"_before_{side}a"), F.col(f"_before_{side}b"))
        nxt = F.least(F.col(f"_after_{side}a"), F.col(f"_after_{side}b"))
        return (F.coalesce(F.col("_t") - last <= back_s * US, F.lit(False)) | F.coalesce(nxt - F.col("_t") <= ahead_s * US, F.lit(False)))

    has = F.when(F.col("_left"), near("r", lower_s, upper_s)).otherwise(near("l", upper_s, lower_s))
    alone = d.where(F.col(key).isNull() | F.col("_t").isNull() | ~has)
    tag = F.when(F.col("_left"), "unmatched_left").otherwise("unmatched_right")
    return (pairs.select(F.lit("matched").alias("tag"), key, lid, rid)
            .unionByName(alone.select(tag.alias("tag"), key, lid, rid)))


SALTS = 16  # parts of a (key, window) in which its unmatched rows are looked for


def window_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, size_s: int,
                how: str = "inner") -> DataFrame:
    """JN-3 / JN-4: join rows of the same key inside the same tumbling window.

    Adds ``window_end`` (epoch ms). ``how='left'`` keeps every left row with
    NULL right columns when its window holds no right row of the key.

    Pairs are an inner join, in which AQE splits a hot (key, window) on either
    side. Left rows without a partner come from an anti join with the (key,
    window)s that the right side has: one row each, ``SALTS`` times, so that the
    left rows of a hot one are spread over as many tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner and left only")
    size = int(size_s) * US
    lw = left.withColumn("_wb", _bucket(F.unix_micros(F.col(lts)), size).cast("bigint"))
    rw = right.withColumn("_wb", _bucket(F.unix_micros(F.col(rts)), size).cast("bigint"))
    j = lw.join(rw, on=[key, "_wb"], how="inner")
    if how == "left":
        there = rw.select(key, "_wb").distinct().withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
        alone = lw.withColumn("_salt", salt).join(there, on=[key, "_wb", "_salt"], how="left_anti").drop("_salt")
        j = j.unionByName(alone, allowMissingColumns=True)
    return j.withColumn("window_end", (F.col("_wb") + 1) * (size // 1000)).drop("_wb")


def lookup(df: DataFrame, small: DataFrame, key: str, small_key: str, value_cols: list[str],
           order_col: str, case_insensitive: bool = True) -> DataFrame:
    """JN-5: lookup join, first match (by ``order_col``) wins.

    The planner and AQE choose the join by the lookup side's size in bytes.
    """
    norm = (lambda c: F.lower(F.col(c))) if case_insensitive else (lambda c: F.col(c))
    dedup = (small.withColumn("_lk", norm(small_key))
                  .groupBy("_lk")
                  .agg(F.min_by(F.struct(*value_cols, small_key), F.col(order_col)).alias("_m")))
    dedup = dedup.select("_lk", *[F.col(f"_m.{c}").alias(c) for c in value_cols],
                         F.col(f"_m.{small_key}").alias("_matched_name"))
    return df.withColumn("_lk", norm(key)).join(dedup, on="_lk", how="left").drop("_lk")
