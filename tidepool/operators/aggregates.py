"""Aggregations (AGG-1..7, AGG-10, AGG-11).

Group-bys run as hash aggregates with map-side partial merge, so hot keys are
combined before the shuffle. Per-event running values use the skew-safe
``keyed_scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidepool.functions.text import ASCII_SPACE, tokenize, tokenize_jvm
from tidepool.operators.sequence import keyed_scan


def word_count(df: DataFrame, text_col: str = "text", pattern: str = ASCII_SPACE,
               jvm_split: bool = False, drop_empty: bool = True) -> DataFrame:
    """AGG-1 + PRJ-6: words and their counts over whole texts."""
    words = tokenize_jvm(df, text_col) if jvm_split else tokenize(df, text_col, pattern, drop_empty)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_count(df: DataFrame, key: str, order: list[str], ts: str,
                  out: str = "running_count") -> DataFrame:
    """AGG-2 (batch, per event): count of the key's events so far."""
    return keyed_scan(df, [key], order, ts, index=out)


def running_sum(df: DataFrame, key: str, order: list[str], ts: str, value: Column,
                out: str = "running_sum") -> DataFrame:
    """AGG-7: inclusive running sum per key."""
    return keyed_scan(df, [key], order, ts, running={out: ("sum", value)})


def rolling_reduce(df: DataFrame, key: str, order: list[str], ts: str, value: str,
                   step_s: int = 1, bump: float = 10.0) -> DataFrame:
    """AGG-6: reduce emitting on every row. The first row passes unchanged;
    afterwards ``(first.ts + (n-1) * step, current.value + bump)``."""
    s = keyed_scan(df.withColumn("_ts_s", F.unix_seconds(F.col(ts))), [key], order, ts,
                   index="row_no", key_first=["_ts_s"])
    return s.select("*",
                    (F.col("first__ts_s") + (F.col("row_no") - 1) * step_s).alias("reduced_ts_s"),
                    F.when(F.col("row_no") == 1, F.col(value))
                     .otherwise(F.col(value) + bump).alias("reduced_value")
                    ).drop("_ts_s", "first__ts_s")


def int_mean(col: Column) -> Column:
    """AGG-5: integer-division mean (as double). Summed as DECIMAL(38,0), so
    a hot group cannot overflow BIGINT."""
    return F.floor(F.sum(col.cast("decimal(38,0)")) / F.count(col)).cast("double")


def payment_totals(df: DataFrame, ok: Column, money: Column, order: Column,
                   when_col: str, money_type: str = "decimal(38,10)") -> DataFrame:
    """AGG-3: all-order count, success count, success money (summed as
    ``money_type``), last success time.

    One global aggregate: each task pre-aggregates, a single tiny merge
    finishes (no single-task bottleneck)."""
    return df.agg(F.count(F.lit(1)).alias("all_orders"),
                  F.count_if(ok).alias("success_orders"),
                  F.sum(F.when(ok, money.cast(money_type))).cast("double").alias("success_money"),
                  F.max_by(F.when(ok, F.col(when_col)), F.when(ok, order)).alias("last_success_time"))


def cumulative_window_count(win_counts: DataFrame, key: str, window_col: str, count: str,
                            out: str = "cumulative") -> DataFrame:
    """AGG-10: running total of per-window counts of a key (never reset).

    Runs over the *aggregated* windows: a key contributes one row per window,
    bounded by time span / window size, not by its event volume."""
    w = Window.partitionBy(key).orderBy(window_col).rowsBetween(Window.unboundedPreceding, 0)
    return win_counts.withColumn(out, F.sum(count).over(w))


def with_metric(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """AGG-11: attach a row counter; read ``obs.get`` after an action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
