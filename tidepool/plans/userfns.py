"""User functions as queries (UDF-2, UDF-4, UDF-5, UDF-6, UDF-9), batch and stream.

The functions below stand for a caller's own; each query's SQL says the same
with built-in functions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.userfns import (Aggregate, map_with_setup, reduce_aggregate, user_aggregate,
                                        window_apply, window_cogroup, window_user_aggregate)
from tidepool.plans.registry import ORACLE, register
from tidepool.plans.sqlfrag import US, ev, sliding
from tidepool.sources.tables import load_events
from tidepool.streaming.runner import events_stream, run_append
from tidepool.streaming.userfns import (stream_window_apply, stream_window_cogroup,
                                        stream_window_user_aggregate)

DAY_S = 86400


# --- UDF-5: a user aggregate in sliding windows ---------------------------------------------
def _cents():
    return F.round(F.col("value") * 100).cast("bigint").alias("v")


def _spread() -> Aggregate:
    """Number, total and range of amounts in cents."""
    def add(s, row):
        v = row[0]
        return (s[0] + 1, s[1] + v, v if s[2] is None else min(s[2], v), v if s[3] is None else max(s[3], v)) if v is not None else s

    def merge(a, b):
        low, high = [x for x in (a[2], b[2]) if x is not None], [x for x in (a[3], b[3]) if x is not None]
        return a[0] + b[0], a[1] + b[1], min(low, default=None), max(high, default=None)

    return Aggregate(lambda: (0, 0, None, None), add, merge,
                     lambda s: (s[0], s[1], None if s[2] is None else s[3] - s[2]), "n long, cents long, spread long")


@register("user_spread_sliding", f"""
WITH w AS ({sliding(ev(), 3600, 300, "event_type, CAST(round(value * 100) AS BIGINT) AS v")})
SELECT event_type, ws // 1000 AS window_start, (ws + {3600 * US}) // 1000 AS window_end,
       count(v) AS n, CAST(coalesce(sum(v), 0) AS BIGINT) AS cents, max(v) - min(v) AS spread
FROM w GROUP BY event_type, ws
""")
def user_spread_sliding(spark, sf):
    rows = load_events(spark, sf).select("event_type", "ts", _cents())
    return window_user_aggregate(rows, "ts", 3600, 300, ["event_type"], ["v"], _spread())


@register("stream_user_spread_sliding", ORACLE["user_spread_sliding"])
def stream_user_spread_sliding(spark, sf):
    sdf, base = events_stream(spark, sf, "user_spread", close=True)
    rows = sdf.select("event_type", "ts", _cents())
    run_append(stream_window_user_aggregate(rows, "ts", 3600, 300, ["event_type"], ["v"], _spread()), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").where("event_type IS NOT NULL")


# --- UDF-4: a user reduce per key ----------------------------------------------------------------
@register("user_reduce", """
SELECT user_id, arg_max(event_id, (value, event_id)) AS best_event_id, max(value) AS best_value,
       max(epoch_us(ts)) AS last_us, count(*) AS n
FROM events GROUP BY user_id
""")
def user_reduce(spark, sf):
    def newer(a, b):
        best = a if (a[1], a[0]) >= (b[1], b[0]) else b
        return best[0], best[1], max(a[2], b[2]), a[3] + b[3]

    rows = load_events(spark, sf).select("user_id", "event_id", "value", F.unix_micros("ts").alias("us"), F.lit(1).cast("long").alias("n"))
    return user_aggregate(rows, ["user_id"], ["event_id", "value", "us", "n"],
                          reduce_aggregate(newer, "best_event_id long, best_value double, last_us long, n long"))


# --- UDF-6: a window body -----------------------------------------------------------------------------
def _longest_pause(key, window, rows):
    """Rows of the window and the longest time between two of them, with the later one's id."""
    last, most, at, n = None, -1, None, 0
    for us, rid in sorted(rows):
        n += 1
        if last is not None and us - last > most:
            most, at = us - last, rid
        last = us
    yield n, at, None if at is None else most // 1000


_PAUSE = "n long, after_event_id long, pause_ms long"


@register("window_body_pause", f"""
WITH s AS (SELECT user_id, event_id, epoch_us(ts) AS t, epoch_us(ts) // {DAY_S * US} AS d,
                  epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id, epoch_us(ts) // {DAY_S * US} ORDER BY ts, event_id) AS gap
           FROM events)
SELECT user_id, d * {DAY_S * 1000} AS window_start, (d + 1) * {DAY_S * 1000} AS window_end, count(*) AS n,
       arg_max(event_id, (gap, -t, -event_id)) FILTER (WHERE gap IS NOT NULL) AS after_event_id, max(gap) // 1000 AS pause_ms
FROM s GROUP BY user_id, d
""")
def window_body_pause(spark, sf):
    rows = load_events(spark, sf).select("user_id", "ts", F.unix_micros("ts").alias("us"), "event_id")
    return window_apply(rows, "ts", DAY_S, None, ["user_id"], ["us", "event_id"], _longest_pause, _PAUSE)


@register("stream_window_body_pause", ORACLE["window_body_pause"])
def stream_window_body_pause(spark, sf):
    sdf, base = events_stream(spark, sf, "window_body", close={"user_id": -1})
    rows = sdf.select("user_id", "ts", F.unix_micros("ts").alias("us"), "event_id")
    run_append(stream_window_apply(rows, "ts", DAY_S, None, ["user_id"], ["us", "event_id"], _longest_pause, _PAUSE), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")


# --- UDF-9: a co-group body --------------------------------------------------------------------------------
def _views_before_clicks(key, window, views, clicks):
    """Views and clicks of the window and how many views came before its first click (all, without one)."""
    clicked = sorted(clicks)
    seen = list(views)
    yield len(seen), len(clicked), sum(1 for v in seen if not clicked or v < clicked[0])


_COGROUP = "views long, clicks long, before long"


@register("window_cogroup_views", f"""
WITH f AS (SELECT user_id, epoch_us(ts) // {DAY_S * US} AS d, min((epoch_us(ts), event_id)) FILTER (WHERE event_type = 'click') AS first_click
           FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL)
SELECT f.user_id, f.d * {DAY_S * 1000} AS window_start, (f.d + 1) * {DAY_S * 1000} AS window_end,
       count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks,
       count(*) FILTER (WHERE event_type = 'view' AND (first_click IS NULL OR (epoch_us(ts), event_id) < first_click)) AS before
FROM f JOIN events e ON e.user_id = f.user_id AND epoch_us(e.ts) // {DAY_S * US} = f.d AND event_type IN ('view', 'click')
GROUP BY ALL
""")
def window_cogroup_views(spark, sf):
    rows = load_events(spark, sf).select("user_id", "ts", "event_type", F.unix_micros("ts").alias("us"), "event_id")
    views, clicks = (rows.where(F.col("event_type") == k) for k in ("view", "click"))
    return window_cogroup(views, clicks, ["user_id"], "ts", DAY_S, ["us", "event_id"], ["us", "event_id"], _views_before_clicks, _COGROUP)


@register("stream_window_cogroup_views", ORACLE["window_cogroup_views"])
def stream_window_cogroup_views(spark, sf):
    sides = []
    for kind in ("view", "click"):
        sdf, base = events_stream(spark, sf, f"cogroup_{kind}", where=F.col("event_type") == kind, close={"user_id": -1})
        sides.append(sdf.select("user_id", "ts", F.unix_micros("ts").alias("us"), "event_id"))
    out = stream_window_cogroup(*sides, ["user_id"], "ts", DAY_S, ["us", "event_id"], ["us", "event_id"], _views_before_clicks, _COGROUP)
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")


# --- UDF-2: a rich map with a resource of the task -----------------------------------------------------------------
@register("rich_map_codes", """
SELECT event_id, upper(substring(event_type, 1, 1)) || '-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS code FROM events
""")
def rich_map_codes(spark, sf):
    def code(letters, row):
        kind = letters.setdefault(row[1], row[1][:1].upper())
        yield row[0], f"{kind}-{row[2]:06d}"

    return map_with_setup(load_events(spark, sf).select("event_id", "event_type", "user_id"), dict, code, dict.clear, "event_id long, code string")
