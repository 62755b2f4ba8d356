"""Stateful detection and sequence patterns, batch form (PAT-1..9).

Each pattern is declarative: per-key event order comes from the skew-safe
``keyed_scan`` (previous/next row, running aggregates, row index), or from
plain grouped aggregates where the contract only needs first/last events.
``sequence`` is the general form; PAT-1 to PAT-4 are sequences.
Streaming forms live in ``tidepool.streaming``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.sequence import deal, dealt_scan, keyed_scan

US = 1_000_000

# Verdict texts of the order jobs.
PAYED, PAYED_LATE, NOT_PAYED, NO_CREATE = ("payed successfully", "payed but already timeout", "order timeout",
                                           "already payed but not found create log")
ORDER_PAYED, ORDER_TIMEOUT = "order payed successfully", "order timeout"


def four_outcomes(create_us: Column, pay_us: Column, limit_us: int) -> Column:
    """PAT-5: the verdict on a key's first create and first pay."""
    both = create_us.isNotNull() & pay_us.isNotNull()
    return (F.when(both & (pay_us < create_us + limit_us), PAYED).when(both, PAYED_LATE)
            .when(create_us.isNotNull(), NOT_PAYED).otherwise(NO_CREATE))


def _with_t(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("t_us", F.unix_micros(F.col(ts)))


@dataclass(frozen=True)
class Step:
    """One step of a sequence: rows where ``where`` holds. ``strict``: it must be
    the very next row of the key (else the attempt is given up without a result);
    otherwise rows that don't fit are passed over."""

    name: str
    where: Column
    strict: bool = False


def sequence(df: DataFrame, keys: list[str], order: list[str], ts: str, steps: list[Step], within_s: int,
             keep: list[str]) -> DataFrame:
    """PAT-2 / UDF-10: general sequence of steps per key.

    Every row that fits the first step starts an attempt. Each later step takes
    the next row of the key that fits it. The attempt is ``matched`` when its
    last step comes less than ``within_s`` after its first, and a ``timeout``
    when time runs out before (or the input ends). Strict steps that the next
    row misses in time end the attempt without a row.

    Output: keys, ``status`` and one struct per step, named after it, with the
    columns ``keep`` of its row (NULL for steps that a timeout did not reach).

    Backwards from the last step, one suffix scan per step carries the rest of
    the chain along, so a hot key stays split into time buckets, no row is
    copied per attempt, and all scans share one shuffle of the rows.
    """
    names = [s.name for s in steps]
    if len(steps) < 2 or len(set(names)) != len(names):
        raise ValueError("a sequence needs two steps or more, with different names")
    needed = list(dict.fromkeys([*keys, *order, ts, *keep]))
    marked = df.select(*needed, F.unix_micros(F.col(ts)).alias("__t"),
                       *[F.coalesce(s.where, F.lit(False)).alias(f"__fits_{i}") for i, s in enumerate(steps)])
    d = deal(marked, keys, ts)
    place = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]  # first fields: a minimum is the next row
    for i in range(len(steps) - 1, 0, -1):
        row = [*place, F.col("__t").alias("t"), F.col(f"__fits_{i}").alias("fits"), F.struct(*keep).alias("row")]
        if i < len(steps) - 1:
            row.append(F.col(f"__after_{i}").alias("after"))
        d = d.withColumn("__step", F.struct(*row))
        if steps[i].strict:
            d = dealt_scan(d, keys, order, nxt=["__step"]).withColumnRenamed("next___step", f"__after_{i - 1}")
        else:
            d = dealt_scan(d, keys, order, reverse=True, exclusive=True,
                           running={f"__after_{i - 1}": ("min", F.when(F.col(f"__fits_{i}"), F.col("__step")))})
        d = d.drop("__step", *([f"__after_{i}"] if i < len(steps) - 1 else []))
    return _judged(d.where("__fits_0"), keys, steps, within_s, keep)


def _judged(starts: DataFrame, keys: list[str], steps: list[Step], within_s: int, keep: list[str]) -> DataFrame:
    """Follow each attempt's chain: steps in time, given up, timed out."""
    chain, going, given_up = F.col("__after_0"), F.lit(True), F.lit(False)
    shown = [F.struct(*keep).alias(steps[0].name)]
    for i, step in enumerate(steps[1:], 1):
        in_time = chain["t"].isNotNull() & (chain["t"] - F.col("__t") < within_s * US)
        if step.strict:
            given_up = given_up | (going & in_time & ~chain["fits"])
        going = going & in_time & chain["fits"]
        shown.append(F.when(going, chain["row"]).alias(step.name))
        chain = chain["after"] if i < len(steps) - 1 else None
    status = F.when(going, "matched").otherwise("timeout")
    return (starts.select(*keys, status.alias("status"), *shown, F.coalesce(given_up, F.lit(False)).alias("__given_up"))
            .where("NOT __given_up").drop("__given_up"))


def _span(hits: DataFrame, key: str, first: str, last: str, ts: str, id_col: str) -> DataFrame:
    at = lambda step: F.floor(F.unix_micros(F.col(f"{step}.{ts}")) / 1000).cast("bigint")
    return hits.where("status = 'matched'").select(
        key, F.col(f"{first}.{id_col}").alias("first_event_id"), F.col(f"{last}.{id_col}").alias("last_event_id"),
        at(first).alias("first_fail_ms"), at(last).alias("last_fail_ms"))


def adjacent_pair(df: DataFrame, key: str, order: list[str], ts: str, type_col: str,
                  first: str, second: str, within_s: int, id_col: str = "event_id") -> DataFrame:
    """PAT-1 / PAT-2: a ``second`` event whose immediately preceding event of the
    key is ``first`` and happened less than ``within_s`` earlier (strict).

    Output: key, first/last ids, first/last times (epoch ms).
    """
    steps = [Step("first", F.col(type_col) == first), Step("last", F.col(type_col) == second, strict=True)]
    return _span(sequence(df, [key], order, ts, steps, within_s, [id_col, ts]), key, "first", "last", ts, id_col)


def n_in_a_row(df: DataFrame, key: str, order: list[str], ts: str, type_col: str, kind: str,
               n: int, within_s: int, id_col: str = "event_id") -> DataFrame:
    """PAT-3: ``n`` consecutive ``kind`` events of a key (nothing else between)
    spanning less than ``within_s``; one row per completing event."""
    if n == 1:
        one = df.where(F.col(type_col) == kind).select(key, F.struct(id_col, ts).alias("s"), F.lit("matched").alias("status"))
        return _span(one, key, "s", "s", ts, id_col)
    steps = [Step(f"s{i}", F.col(type_col) == kind, strict=i > 0) for i in range(n)]
    return _span(sequence(df, [key], order, ts, steps, within_s, [id_col, ts]), key, "s0", f"s{n - 1}", ts, id_col)


def followed_by_within(df: DataFrame, keys: list[str], order: list[str], ts: str,
                       type_col: str, start: str, end: str, within_s: int, keep: list[str]) -> DataFrame:
    """PAT-4: relaxed sequence ``start`` ... ``end`` within a time limit.

    Every ``start`` row is judged against the earliest later ``end`` row of the
    key: ``matched`` when it comes less than ``within_s`` later, otherwise a
    ``timeout``. ``end`` rows without a start give nothing. Output: keys,
    ``status``, structs ``start`` and ``end`` with the columns ``keep``.
    """
    steps = [Step("start", F.col(type_col) == start), Step("end", F.col(type_col) == end)]
    return sequence(df, keys, order, ts, steps, within_s, keep)


def first_events(df: DataFrame, keys: list[str], ts: str, type_col: str, kinds: list[str],
                 id_col: str = "event_id") -> DataFrame:
    """First event (by time, then id) of each kind per key: ``first_<kind>_us``
    and ``first_<kind>_id``. Grouped aggregate with map-side partial merge."""
    d = _with_t(df, ts)
    aggs = []
    for k in kinds:
        st = F.when(F.col(type_col) == k, F.struct(F.col("t_us").alias("t"), F.col(id_col).alias("i")))
        aggs.append(F.min(st).alias(f"_f_{k}"))
    g = d.groupBy(*keys).agg(*aggs)
    for k in kinds:
        g = (g.withColumn(f"first_{k}_us", F.col(f"_f_{k}.t"))
              .withColumn(f"first_{k}_id", F.col(f"_f_{k}.i")).drop(f"_f_{k}"))
    return g


def match_orders(df: DataFrame, keys: list[str], ts: str, type_col: str, create: str, pay: str,
                 timeout_s: int) -> DataFrame:
    """PAT-5: four outcomes per key from its first create and first pay."""
    g = first_events(df, keys, ts, type_col, [create, pay])
    c, p = F.col(f"first_{create}_us"), F.col(f"first_{pay}_us")
    res = four_outcomes(c, p, timeout_s * US)
    return g.select(*keys, res.alias("result"))


def order_verdict(df: DataFrame, keys: list[str], ts: str, type_col: str, create: str, pay: str,
                  timeout_s: int) -> DataFrame:
    """PAT-6: verdict at first create + timeout; keys paid before their first
    create give no row."""
    g = first_events(df, keys, ts, type_col, [create, pay])
    c, p = F.col(f"first_{create}_us"), F.col(f"first_{pay}_us")
    ci, pi = F.col(f"first_{create}_id"), F.col(f"first_{pay}_id")
    pay_first = p.isNotNull() & ((p < c) | ((p == c) & (pi < ci)))
    ok = p.isNotNull() & (p <= c + timeout_s * US)
    return (g.where(c.isNotNull() & ~pay_first)
             .select(*keys, F.when(ok, ORDER_PAYED).otherwise(ORDER_TIMEOUT)
                     .alias("result")))


def cap_per_key(df: DataFrame, keys: list[str], order: list[str], cap: int,
                out: str = "click_no") -> DataFrame:
    """PAT-7: number rows per key up to ``cap + 1``.

    ``row_number() <= cap + 1`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so a hot key ships at most ``cap + 1`` rows per map
    task. Rows ``<= cap`` pass; row ``cap + 1`` raises the single warning.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order])
    return (df.withColumn(out, F.row_number().over(w))
              .where(F.col(out) <= cap + 1)
              .withColumn(out, F.col(out).cast("bigint")))


def jump_alert(df: DataFrame, key: str, order: list[str], ts: str, value: str,
               threshold: float) -> DataFrame:
    """PAT-8: ``|value - previous value| > threshold``; the first row never alerts."""
    s = keyed_scan(df, [key], order, ts, prev=[value])
    return s.where(F.abs(F.col(value) - F.col(f"prev_{value}")) > threshold)


def rising_alert(df: DataFrame, key: str, order: list[str], ts: str, value: str,
                 duration_s: int) -> DataFrame:
    """PAT-9: value keeps rising (no drop) for ``duration_s`` after the first rise.

    Runs start at a drop (or the key's first row); equal values neither start
    nor cancel. One alert per run, at first rise + duration, when the next drop
    comes strictly later (or never).
    """
    d = deal(_with_t(df.select(*dict.fromkeys([key, *order, ts, value])), ts), [key], ts)
    s = dealt_scan(d, [key], order, prev=[value])
    pv = F.col(f"prev_{value}")
    s = (s.withColumn("_drop", F.when(pv.isNull() | (F.col(value) < pv), 1).otherwise(0))
          .withColumn("_rise", F.when(F.col(value) > pv, F.col("t_us"))))
    r = dealt_scan(s, [key], order, running={"run_id": ("sum", F.col("_drop"))})
    # a run is long or short: combined per task, then one row a run
    runs = r.groupBy(key, "run_id").agg(F.min("t_us").alias("run_start"), F.min("_rise").alias("first_rise"))
    runs = runs.withColumn("_at", F.timestamp_micros("run_start"))
    j = keyed_scan(runs, [key], ["_at", "run_id"], "_at", nxt=["run_start"])
    lim = F.col("first_rise") + duration_s * US
    return (j.where(F.col("first_rise").isNotNull()
                    & (F.col("next_run_start").isNull() | (F.col("next_run_start") > lim)))
             .select(key, F.floor(F.col("first_rise") / 1000).cast("bigint").alias("rise_start_ms"),
                     F.floor(lim / 1000).cast("bigint").alias("alert_ms")))
