"""Time and count windows (WIN-*), with the pane rewrite for sliding windows.

Window bounds are epoch-aligned and half-open ``[start, end)``. Outputs carry
``window_start`` / ``window_end`` as epoch milliseconds (BIGINT).

Delta form (default for sliding count/sum): each row becomes two deltas, a
skew-safe running sum per key gives the value between change points, and the
windows are generated after the last shuffle — no row is replicated
``size/slide`` times (see ``sliding_agg_deltas``).

Pane rewrite (OPT-P, used for min/max): a sliding window of ``size``/``slide``
copies each row ``size/slide`` times. For mergeable aggregates (count, sum, min, max) we first
aggregate tumbling panes of ``gcd(size, slide)`` and only replicate the pane
partials, so the fan-out applies to panes, not rows. Both steps use Spark's
one ``explode`` of the valid window starts plus a hash aggregate with
map-side partial merge.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.sequence import DEFAULT_SPLIT_SECONDS, deal, dealt_scan, keyed_scan

PANE_MIN_FAN_OUT = 12
_MERGE = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
_FN = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def _dur(seconds: int) -> str:
    return f"{int(seconds)} seconds"


def _measure(kind: str, col) -> Column:
    if kind == "count":
        return F.count(F.lit(1)) if col is None else F.count(col)
    return _FN[kind](col)


def window_starts(t_us: Column, size_s: int, slide_s: int) -> Column:
    """Array of the starts (epoch µs) of every window ``[s, s+size)`` holding ``t_us``.

    ``sequence(first, last, slide)`` lists exactly the valid windows, so one
    ``explode`` replaces the per-slide ``Expand`` projections of
    ``F.window`` (hundreds of them for 1 h / 5 s, which defeats codegen).
    """
    size, slide = int(size_s) * 1_000_000, int(slide_s) * 1_000_000
    return F.sequence(floor_to(t_us - F.lit(size), slide) + F.lit(slide), floor_to(t_us, slide),
                      F.lit(slide).cast("bigint"))


def floor_to(t_us: Column, step_us: int) -> Column:
    """Largest multiple of ``step_us`` not above ``t_us`` (exact integer math)."""
    return t_us - F.pmod(t_us, F.lit(int(step_us)).cast("bigint"))


def window_agg(df: DataFrame, ts: str, size_s: int, slide_s: int | None = None,
               keys: list[str] | None = None,
               measures: dict[str, tuple[str, str | Column | None]] | None = None,
               panes: bool | None = None, method: str | None = None) -> DataFrame:
    """Tumbling (``slide_s`` None) or sliding keyed aggregate (batch).

    ``measures``: ``{out: (kind, col)}``, kind in count/sum/min/max.
    ``method`` for sliding windows: ``deltas`` (count/sum: no row replication,
    see ``sliding_agg_deltas``; the default when it applies), ``panes`` or
    ``direct``. ``panes=True/False`` forces ``panes``/``direct``.
    ``panes``: force/deny the pane rewrite; default on when fan-out > 12
    (at that replication the pane partials pay for their extra shuffle as soon
    as a few events share a (key, pane); on very sparse keys direct is cheaper).
    Output: keys, ``window_start``, ``window_end`` (epoch ms), measures.
    """
    keys = list(keys or [])
    measures = measures or {"cnt": ("count", None)}
    slide_s = slide_s or size_s
    fan_out = -(-size_s // slide_s)
    invertible = all(k in ("count", "sum") for k, _ in measures.values())
    if method is None and panes is None and fan_out > 1 and invertible:
        method = "deltas"
    if method == "deltas":
        return sliding_agg_deltas(df, ts, size_s, slide_s, keys, measures)
    if method is not None:
        panes = method == "panes"
    use_panes = (fan_out > PANE_MIN_FAN_OUT) if panes is None else (panes and fan_out > 1)
    t_us = F.unix_micros(F.col(ts))
    if fan_out == 1:
        pane_us = int(size_s) * 1_000_000
        win = (df.groupBy(*keys, floor_to(t_us, pane_us).alias("_ws"))
                 .agg(*[_measure(k, c).alias(n) for n, (k, c) in measures.items()]))
    elif use_panes:
        pane_us = gcd(int(size_s), int(slide_s)) * 1_000_000
        pane = (df.groupBy(*keys, floor_to(t_us, pane_us).alias("_p"))
                  .agg(*[_measure(k, c).alias(n) for n, (k, c) in measures.items()]))
        win = (pane.select(*keys, F.explode(window_starts(F.col("_p"), size_s, slide_s)).alias("_ws"),
                           *measures.keys())
                   .groupBy(*keys, "_ws")
                   .agg(*[_FN[_MERGE[k]](n).alias(n) for n, (k, _) in measures.items()]))
    else:
        cols = [F.col(c) if isinstance(c, str) else c for _, (_, c) in measures.items() if c is not None]
        ex = df.select(*keys, *[c for c in cols],
                       F.explode(window_starts(t_us, size_s, slide_s)).alias("_ws"))
        win = (ex.groupBy(*keys, "_ws")
                 .agg(*[_measure(k, c).alias(n) for n, (k, c) in measures.items()]))
    size_ms = int(size_s) * 1000
    return win.select(*keys, F.expr("_ws div 1000").alias("window_start"),
                      (F.expr("_ws div 1000") + size_ms).alias("window_end"),
                      *measures.keys())


def sliding_count(df: DataFrame, ts: str, keys: list[str], size_s: int, slide_s: int,
                  out: str = "cnt", panes: bool | None = None,
                  method: str | None = None) -> DataFrame:
    """WIN-4 / WIN-6: sliding keyed count (delta form by default)."""
    return window_agg(df, ts, size_s, slide_s, keys, {out: ("count", None)}, panes, method)


def assign_windows(df: DataFrame, ts: str, size_s: int, slide_s: int | None = None) -> DataFrame:
    """Attach every window holding the row: ``window_start``/``window_end`` (epoch ms)."""
    slide_s = slide_s or size_s
    ws = F.explode(window_starts(F.unix_micros(F.col(ts)), size_s, slide_s))
    return (df.select("*", ws.alias("_ws"))
              .withColumn("window_start", F.expr("_ws div 1000"))
              .withColumn("window_end", F.col("window_start") + int(size_s) * 1000)
              .drop("_ws"))


def window_running_count(df: DataFrame, ts: str, key: str, order: list[str], size_s: int,
                         slide_s: int, out: str = "running_count") -> DataFrame:
    """WIN-8: inside each (key, window), number the rows 1..n in event order."""
    w = assign_windows(df, ts, size_s, slide_s)
    return keyed_scan(w, [key, "window_start"], order, ts, index=out,
                      split_seconds=max(60, size_s // 24))


def count_window(df: DataFrame, key: str, order: list[str], ts: str, n: int,
                 measures: dict[str, tuple[str, str]]) -> DataFrame:
    """WIN-12: tumbling count window of ``n`` rows per key; incomplete tail dropped."""
    idx = keyed_scan(df, [key], order, ts, index="_rn_")
    g = idx.withColumn("window_no", F.floor((F.col("_rn_") - 1) / n).cast("bigint") + 1)
    aggs = [_measure(k, F.col(c)).alias(name) for name, (k, c) in measures.items()]
    return (g.groupBy(key, "window_no")
             .agg(F.count(F.lit(1)).alias("_n"), *aggs)
             .where(F.col("_n") == n).drop("_n"))


def sliding_count_window(df: DataFrame, key: str, order: list[str], ts: str, size: int,
                         slide: int, value: str, out: str = "sum_value") -> DataFrame:
    """WIN-13: every ``slide`` rows of a key, sum ``value`` over the last ``size`` rows.

    Prefix sums from ``keyed_scan`` and one equi-join on ``(key, index - size)``
    replace a per-key buffer: no key is ever collected into one task.
    """
    sc = keyed_scan(df, [key], order, ts, index="row_no",
                    running={"_ps": ("sum", F.col(value))})
    fire = sc.where(F.col("row_no") % slide == 0)
    back = sc.select(F.col(key), (F.col("row_no") + size).alias("row_no"),
                     F.col("_ps").alias("_ps_back"))
    res = fire.join(back, on=[key, "row_no"], how="left")
    return res.select(key, "row_no",
                      (F.col("_ps") - F.coalesce("_ps_back", F.lit(0.0))).alias(out))


def every_nth(df: DataFrame, key: str, order: list[str], ts: str, n: int) -> DataFrame:
    """WIN-15: emit every ``n``-th row of a key (counter resets after each emit)."""
    idx = keyed_scan(df, [key], order, ts, index="row_no")
    return idx.where(F.col("row_no") % n == 0)


def session_agg(df: DataFrame, ts: str, key: str, gap_s: int,
                measures: dict[str, tuple[str, str | Column | None]] | None = None,
                split_seconds: int = DEFAULT_SPLIT_SECONDS) -> DataFrame:
    """WIN-14: session windows with inactivity gap (end = last event + gap; an
    event exactly ``gap`` after the last one still joins). Rows without a time
    are in no session.

    Each key is split into time segments: a row begins a session when the row
    before it, in its segment or at the end of the last one, is more than the
    gap away; a running number of such rows names the session. Both scans share
    one shuffle, and a session's rows are combined per segment before its parts
    meet, so neither a hot key nor an endless session gathers in one task.
    (The built-in ``session_window`` sorts all rows of a key in one task.)
    """
    measures = measures or {"cnt": ("count", None)}
    inputs = {n: c for n, (_, c) in measures.items() if c is not None}
    rows = df.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.unix_micros(F.col(ts)).alias("_t"),
        *[(F.col(c) if isinstance(c, str) else c).alias(f"_m_{n}") for n, c in inputs.items()])
    d = dealt_scan(deal(rows, ["_key"], "_ts", split_seconds), ["_key"], ["_ts"], prev=["_t"])
    apart = F.col("_t") - F.col("prev__t") > int(gap_s) * 1_000_000
    # of rows with one time, the one that begins a session is the first
    d = d.withColumn("_goes_on", F.when(F.col("prev__t").isNull() | apart, 0).otherwise(1))
    d = dealt_scan(d, ["_key"], ["_ts", "_goes_on"], running={"_session": ("sum", 1 - F.col("_goes_on"))})
    start, end = F.min("_t"), F.max("_t") + int(gap_s) * 1_000_000
    out = d.groupBy("_key", "_session").agg(start.alias("_s"), end.alias("_e"), *[
        _measure(k, None if c is None else F.col(f"_m_{n}")).alias(n) for n, (k, c) in measures.items()])
    return out.select(F.col("_key").alias(key), F.floor(F.col("_s") / 1000).cast("bigint").alias("session_start"),
                      F.floor(F.col("_e") / 1000).cast("bigint").alias("session_end"), *measures.keys())


def sliding_agg_deltas(df: DataFrame, ts: str, size_s: int, slide_s: int,
                       keys: list[str] | None = None,
                       measures: dict[str, tuple[str, str | Column | None]] | None = None,
                       split_seconds: int | None = None) -> DataFrame:
    """Sliding count/sum without replicating rows (difference array + prefix sums).

    A row at ``t`` belongs to the window starts ``first(t) .. last(t)``; it adds
    ``+v`` at ``first(t)`` and ``-v`` at ``last(t) + slide``. Per key, a running
    sum of these deltas ordered by window start (skew-safe ``keyed_scan``)
    gives the value on each stretch between two change points, and each
    stretch with a positive count expands locally into its windows.

    Only two delta rows per input row are shuffled (fewer after the map-side
    combine), instead of ``size/slide`` copies; the windows are generated
    after the last shuffle, without a final aggregate. Count/sum only (min/max
    are not invertible: use ``window_agg``).
    """
    keys = list(keys or [])
    measures = measures or {"cnt": ("count", None)}
    for kind, _ in measures.values():
        if kind not in ("count", "sum"):
            raise ValueError("sliding_agg_deltas supports count and sum only")
    size, slide = int(size_s) * 1_000_000, int(slide_s) * 1_000_000
    t_us = F.unix_micros(F.col(ts))
    first = floor_to(t_us - F.lit(size), slide) + F.lit(slide)
    after = floor_to(t_us, slide) + F.lit(slide)
    vals = {"__n": F.lit(1).cast("bigint")}
    for name, (kind, col) in measures.items():  # NULLs neither count nor add
        c = F.col(col) if isinstance(col, str) else col
        if kind == "sum":
            vals[name] = F.coalesce(c, F.lit(0))
        if c is not None:
            vals[f"__c_{name}"] = F.when(c.isNotNull(), 1).otherwise(0).cast("bigint")
    deltas = F.array(
        F.struct(first.alias("ws"), *[v.alias(n) for n, v in vals.items()]),
        F.struct(after.alias("ws"), *[(-v).alias(n) for n, v in vals.items()]))
    d = (df.select(*keys, F.explode(deltas).alias("_d"))
           .select(*keys, "_d.*")
           .groupBy(*keys, "ws").agg(*[F.sum(n).alias(n) for n in vals]))
    d = d.withColumn("_wts", F.timestamp_micros("ws"))
    running = {f"r{n}": ("sum", F.col(n)) for n in vals}
    scan_keys = keys
    if not keys:  # global window: one constant key, still split by time buckets
        d, scan_keys = d.withColumn("_all", F.lit(0)), ["_all"]
    scanned = keyed_scan(d, scan_keys, ["_wts"], "_wts", running=running, nxt=["ws"],
                         split_seconds=split_seconds or max(int(size_s) * 4, 3600))
    live = scanned.where(F.col("r__n") > 0)
    starts = F.explode(F.sequence(F.col("ws"), F.col("next_ws") - F.lit(slide), F.lit(slide).cast("bigint")))
    out = live.select(*keys, starts.alias("_ws"), *[F.col(f"r{n}").alias(n) for n in vals])
    size_ms = int(size_s) * 1000
    cols = []
    for name, (kind, col) in measures.items():
        held = F.col("__n" if col is None else f"__c_{name}")
        cols.append((held if kind == "count" else F.when(held > 0, F.col(name))).alias(name))
    return out.select(*keys, F.expr("_ws div 1000").alias("window_start"),
                      (F.expr("_ws div 1000") + size_ms).alias("window_end"), *cols)
