"""Window and top-N analytics on ``events`` (WIN-*, TOP-*, AGG-8/9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.distinct import uv_exact, uv_from_sketches, uv_sketches
from tidepool.operators.ranking import render_ranking, top_n
from tidepool.operators.windows import (count_window, every_nth, session_agg, sliding_count,
                                        sliding_count_window, window_agg, window_running_count)
from tidepool.plans.registry import register
from tidepool.plans.sqlfrag import US, ev, sliding
from tidepool.sources.tables import load_events, load_table

ORDER = ["ts", "event_id"]

# Marketing channel names (channel = user_id % 4, in this order).
CHANNELS = ["wechat", "weibo", "appstore", "huaweistore"]


def _channel(col="user_id"):
    expr = None
    for i, name in enumerate(CHANNELS):
        expr = (F.when(F.pmod(F.col(col), F.lit(4)) == i, name) if expr is None
                else expr.when(F.pmod(F.col(col), F.lit(4)) == i, name))
    return expr


_CHANNEL_SQL = "CASE user_id % 4 " + " ".join(
    f"WHEN {i} THEN '{n}'" for i, n in enumerate(CHANNELS)) + " END"


# --- hot items: FIL-1 + WIN-4 (1 h / 5 min) + TOP-1 -------------------------------
@register("hot_items", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 3600, 300, "item_id")}),
c AS (SELECT item_id, (ws + {3600 * US}) // 1000 AS window_end, count(*) AS view_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id)
      AS top_rank FROM c)
SELECT window_end, item_id, view_count, top_rank FROM r WHERE top_rank <= 3
""")
def hot_items(spark, sf):
    views = load_events(spark, sf).where(F.col("event_type") == "view")
    counts = sliding_count(views, "ts", ["item_id"], 3600, 300, out="view_count")
    return (top_n(counts, ["window_end"], "view_count", ["item_id"], 3, rank_col="top_rank")
            .select("window_end", "item_id", "view_count", "top_rank"))


# --- TOP-3: composite key item-user --------------------------------------------------
@register("hot_items_composite", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 3600, 300,
                    "CAST(item_id AS VARCHAR) || '-' || CAST(user_id AS VARCHAR) AS item_user")}),
c AS (SELECT item_user, (ws + {3600 * US}) // 1000 AS window_end, count(*) AS view_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_user)
      AS top_rank FROM c)
SELECT window_end, item_user, view_count, top_rank FROM r WHERE top_rank <= 3
""")
def hot_items_composite(spark, sf):
    views = (load_events(spark, sf).where(F.col("event_type") == "view")
             .withColumn("item_user", F.concat_ws("-", "item_id", "user_id")))
    counts = sliding_count(views, "ts", ["item_user"], 3600, 300, out="view_count")
    return (top_n(counts, ["window_end"], "view_count", ["item_user"], 3, rank_col="top_rank")
            .select("window_end", "item_user", "view_count", "top_rank"))


# --- TOP-2: clicks, 10 min / 5 s (fan-out 120, pane form), top 5 ---------------------
@register("hot_pages_top5", f"""
WITH w AS ({sliding(ev("event_type = 'click'"), 600, 5, "item_id")}),
c AS (SELECT item_id, (ws + {600 * US}) // 1000 AS window_end, count(*) AS click_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY click_count DESC, item_id)
      AS top_rank FROM c)
SELECT window_end, item_id, click_count, top_rank FROM r WHERE top_rank <= 5
""")
def hot_pages_top5(spark, sf):
    clicks = load_events(spark, sf).where(F.col("event_type") == "click")
    counts = sliding_count(clicks, "ts", ["item_id"], 600, 5, out="click_count")
    return (top_n(counts, ["window_end"], "click_count", ["item_id"], 5, rank_col="top_rank")
            .select("window_end", "item_id", "click_count", "top_rank"))


# --- TOP-4: ranking rendered as one text block per window ---------------------------
@register("hot_items_report", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 3600, 300, "item_id")}),
c AS (SELECT item_id, (ws + {3600 * US}) // 1000 AS window_end, count(*) AS view_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id)
      AS top_rank FROM c)
SELECT window_end, string_agg(printf('No%d: id=%d count=%d', top_rank, item_id, view_count),
                              chr(10) ORDER BY top_rank) AS report
FROM r WHERE top_rank <= 3 GROUP BY window_end
""")
def hot_items_report(spark, sf):
    ranked = hot_items(spark, sf)
    return render_ranking(ranked, "window_end", "item_id", "view_count", rank_col="top_rank")


# --- WIN-1: hourly PV ------------------------------------------------------------------
@register("pv_hourly", f"""
SELECT (t // {3600 * US} + 1) * 3600000 AS window_end, count(*) AS pv
FROM ({ev("event_type = 'view'")}) GROUP BY ALL
""")
def pv_hourly(spark, sf):
    views = load_events(spark, sf).where(F.col("event_type") == "view")
    return window_agg(views, "ts", 3600, measures={"pv": ("count", None)}).select("window_end", "pv")


# --- WIN-2: global tumbling 5 s count --------------------------------------------------
@register("window_count_global", f"""
SELECT (t // {5 * US}) * 5000 AS window_start, (t // {5 * US} + 1) * 5000 AS window_end,
       count(*) AS cnt
FROM ({ev()}) GROUP BY ALL
""")
def window_count_global(spark, sf):
    return window_agg(load_events(spark, sf), "ts", 5)


# --- WIN-11: tumbling keyed sum, 10 s ----------------------------------------------------
@register("tumbling_sum", f"""
SELECT user_id, (t // {10 * US}) * 10000 AS window_start, (t // {10 * US} + 1) * 10000 AS window_end,
       round(sum(value), 2) AS sum_value
FROM ({ev()}) GROUP BY ALL
""")
def tumbling_sum(spark, sf):
    w = window_agg(load_events(spark, sf), "ts", 10, keys=["user_id"],
                   measures={"sum_value": ("sum", "value")})
    return w.withColumn("sum_value", F.round("sum_value", 2))


# --- AGG-8 / WIN-3: exact hourly UV ------------------------------------------------------
@register("uv_hourly_exact", f"""
SELECT (t // {3600 * US} + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS uv
FROM ({ev("event_type = 'view'")}) GROUP BY ALL
""")
def uv_hourly_exact(spark, sf):
    views = load_events(spark, sf).where(F.col("event_type") == "view")
    return uv_exact(views, "ts", "user_id", 3600).select("window_end", "uv")


# --- AGG-9: hourly UV from sketches beside the exact count ---------------------------------
# On the driver's tables a window has few users, where the sketch's estimate is the exact
# number; its error on many users is bounded by a test.
@register("uv_hourly_approx", f"""
SELECT (t // {3600 * US} + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS uv_sketch, count(DISTINCT user_id) AS uv
FROM ({ev("event_type = 'view'")}) GROUP BY ALL
""")
def uv_hourly_approx(spark, sf):
    views = load_events(spark, sf).where(F.col("event_type") == "view").select("ts", "user_id")
    sketch = uv_from_sketches(uv_sketches(views, "ts", "user_id", 3600), 3600).select("window_end", "uv_sketch")
    return sketch.join(uv_exact(views, "ts", "user_id", 3600).select("window_end", "uv"), "window_end", "full")


# --- AGG-9: UV of sliding windows, 6 h / 1 h, from stored hourly sketches ---------------------
@register("uv_sliding_sketch", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 6 * 3600, 3600, "user_id")})
SELECT ws // 1000 AS window_start, (ws + {6 * 3600 * US}) // 1000 AS window_end, count(DISTINCT user_id) AS uv_sketch
FROM w GROUP BY ws
""")
def uv_sliding_sketch(spark, sf):
    views = load_events(spark, sf).where(F.col("event_type") == "view").select("ts", "user_id")
    return uv_from_sketches(uv_sketches(views, "ts", "user_id", 3600), 6 * 3600, 3600)


# --- FIL-2 + WIN-6: channel counts, 1 h / 10 s (fan-out 360) -----------------------------
@register("channel_counts", f"""
WITH w AS ({sliding(ev("event_type <> 'signup'"), 3600, 10,
                    f"{_CHANNEL_SQL} AS channel, event_type AS behavior")})
SELECT channel, behavior, ws // 1000 AS window_start, (ws + {3600 * US}) // 1000 AS window_end,
       count(*) AS cnt
FROM w GROUP BY ALL
""")
def channel_counts(spark, sf):
    ev_ = (load_events(spark, sf).where(F.col("event_type") != "signup")
           .select("ts", F.pmod("user_id", F.lit(4)).alias("channel_no"),
                   F.col("event_type").alias("behavior")))
    # count on the narrow channel number; the name is attached after aggregation
    w = sliding_count(ev_, "ts", ["channel_no", "behavior"], 3600, 10)
    return w.select(_channel("channel_no").alias("channel"), "behavior", "window_start",
                    "window_end", "cnt")


# --- WIN-7: global marketing total with literal labels, 1 h / 10 s -----------------------
@register("marketing_total", f"""
WITH w AS ({sliding(ev("event_type <> 'signup'"), 3600, 10, "1 AS one")})
SELECT ws // 1000 AS window_start, (ws + {3600 * US}) // 1000 AS window_end,
       'app marketing' AS channel, 'total' AS behavior, count(*) AS cnt
FROM w GROUP BY ALL
""")
def marketing_total(spark, sf):
    ev_ = load_events(spark, sf).where(F.col("event_type") != "signup").select("ts")
    w = sliding_count(ev_, "ts", [], 3600, 10)
    return w.select("window_start", "window_end", F.lit("app marketing").alias("channel"),
                    F.lit("total").alias("behavior"), "cnt")


# --- WIN-5: sliding min, 10 s / 3 s (size not a multiple of slide) -----------------------
@register("sliding_min", f"""
WITH w AS ({sliding(ev(), 10, 3, "user_id, value")})
SELECT user_id, ws // 1000 AS window_start, (ws + {10 * US}) // 1000 AS window_end,
       min(value) AS min_value
FROM w GROUP BY ALL
""")
def sliding_min(spark, sf):
    return window_agg(load_events(spark, sf), "ts", 10, 3, ["user_id"],
                      {"min_value": ("min", "value")})


# --- WIN-8: running count per element inside each (user, window), 1 day / 6 h -----------
@register("window_running_count", f"""
WITH w AS ({sliding(ev(), 86400, 21600, "event_id, user_id, t")})
SELECT event_id, user_id, ws // 1000 AS window_start, (ws + {86400 * US}) // 1000 AS window_end,
       row_number() OVER (PARTITION BY user_id, ws ORDER BY t, event_id) AS running_count
FROM w
""")
def window_running_count_q(spark, sf):
    ev_ = load_events(spark, sf).select("event_id", "user_id", "ts")
    r = window_running_count(ev_, "ts", "user_id", ORDER, 86400, 21600)
    return r.select("event_id", "user_id", "window_start", "window_end", "running_count")


# --- WIN-12: tumbling count window of 5 rows per user, min value ------------------------
@register("count_window_min", """
WITH r AS (SELECT user_id, value,
                  (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 5 + 1
                  AS window_no FROM events)
SELECT user_id, window_no, min(value) AS min_value FROM r GROUP BY ALL HAVING count(*) = 5
""")
def count_window_min(spark, sf):
    ev_ = load_events(spark, sf).select("event_id", "user_id", "ts", "value")
    return count_window(ev_, "user_id", ORDER, "ts", 5, {"min_value": ("min", "value")})


# --- WIN-13: every 2 rows, sum of the last 10 rows per user -----------------------------
@register("count_window_sliding_sum", """
WITH r AS (SELECT user_id,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_no,
                  sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s
           FROM events)
SELECT user_id, row_no, round(s, 2) AS sum_value FROM r WHERE row_no % 2 = 0
""")
def count_window_sliding_sum(spark, sf):
    ev_ = load_events(spark, sf).select("event_id", "user_id", "ts", "value")
    r = sliding_count_window(ev_, "user_id", ORDER, "ts", 10, 2, "value")
    return r.withColumn("sum_value", F.round("sum_value", 2))


# --- WIN-14: sessions per user, gap 6 h -------------------------------------------------
@register("session_counts", f"""
WITH g AS (SELECT user_id, t, CASE WHEN lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id)
                                   > t - {6 * 3600 * US} THEN 0 ELSE 1 END AS new_s,
                  event_id FROM ({ev()})),
s AS (SELECT user_id, t, sum(new_s) OVER (PARTITION BY user_id ORDER BY t, event_id) AS sid FROM g)
SELECT user_id, min(t) // 1000 AS session_start, (max(t) + {6 * 3600 * US}) // 1000 AS session_end,
       count(*) AS cnt
FROM s GROUP BY user_id, sid
""")
def session_counts(spark, sf):
    return session_agg(load_events(spark, sf), "ts", "user_id", 6 * 3600)


# --- WIN-15: every 3rd event of a user --------------------------------------------------
@register("every_nth", """
SELECT event_id, user_id, row_no FROM (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_no
  FROM events) WHERE row_no % 3 = 0
""")
def every_nth_q(spark, sf):
    ev_ = load_events(spark, sf).select("event_id", "user_id", "ts")
    return every_nth(ev_, "user_id", ORDER, "ts", 3).select("event_id", "user_id", "row_no")
