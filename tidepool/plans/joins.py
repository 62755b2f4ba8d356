"""Join analytics on ``events`` (JN-1..5).

purchases = ``event_type = 'purchase'`` (pay side), clicks = ``'click'``
(receipt side); views = ``'view'``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.joins import interval_join, lookup, reconcile, window_join
from tidepool.plans.registry import register
from tidepool.plans.sqlfrag import US
from tidepool.sources.tables import load_events
from tidepool.sources.text import from_rows

BAND_S = 30 * 60
WJ_SIZE_S = 3600

# Lookup table (name, factor) in list order; names are matched
# case-insensitively and the first match wins.
LOOKUP_ROWS = [("View", 1.5), ("CLICK", 2.0), ("Purchase", 10.0), ("view", 99.0)]
NO_MATCH_NAME, NO_MATCH_AMOUNT = "###", 0.0

_LOOKUP_VALUES = ", ".join(f"({i}, '{n}', {f})" for i, (n, f) in enumerate(LOOKUP_ROWS))


def _side(spark, sf, kind, prefix):
    ev = load_events(spark, sf).where(F.col("event_type") == kind)
    return ev.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))


_PAIRS = f"""
WITH p AS (SELECT user_id, event_id AS purchase_id, epoch_us(ts) AS pt FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, event_id AS click_id, epoch_us(ts) AS ct FROM events WHERE event_type = 'click'),
m AS (SELECT p.user_id, purchase_id, click_id, pt, ct FROM p JOIN c ON p.user_id = c.user_id
      AND c.ct BETWEEN p.pt - {BAND_S * US} AND p.pt + {BAND_S * US})
"""


# --- JN-1: interval join ------------------------------------------------------------------
@register("interval_join", _PAIRS + """
SELECT user_id, purchase_id, click_id, pt // 1000 AS purchase_ms, ct // 1000 AS click_ms FROM m
""")
def interval_join_q(spark, sf):
    p, c = _side(spark, sf, "purchase", "purchase"), _side(spark, sf, "click", "click")
    j = interval_join(p, c, "user_id", "purchase_ts", "click_ts", BAND_S, BAND_S)
    return j.select("user_id", "purchase_id", "click_id",
                    F.unix_millis("purchase_ts").alias("purchase_ms"),
                    F.unix_millis("click_ts").alias("click_ms"))


# --- JN-2: reconciliation (matched + unmatched on both sides) -------------------------------
@register("reconcile", _PAIRS + """
SELECT 'matched' AS tag, user_id, purchase_id, click_id FROM m
UNION ALL
SELECT 'unmatched_left', user_id, purchase_id, NULL FROM p
WHERE purchase_id NOT IN (SELECT purchase_id FROM m)
UNION ALL
SELECT 'unmatched_right', user_id, NULL, click_id FROM c
WHERE click_id NOT IN (SELECT click_id FROM m)
""")
def reconcile_q(spark, sf):
    p, c = _side(spark, sf, "purchase", "purchase"), _side(spark, sf, "click", "click")
    return reconcile(p, c, "user_id", "purchase_ts", "click_ts", "purchase_id", "click_id",
                     BAND_S, BAND_S)


_WJ = f"""
WITH v AS (SELECT user_id, event_id AS view_id, epoch_us(ts) // {WJ_SIZE_S * US} AS b
           FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id AS click_id, epoch_us(ts) // {WJ_SIZE_S * US} AS b
      FROM events WHERE event_type = 'click')
"""


# --- JN-3 / JN-4: tumbling-window joins -------------------------------------------------------
@register("window_join_inner", _WJ + f"""
SELECT v.user_id, (v.b + 1) * {WJ_SIZE_S * 1000} AS window_end, view_id, click_id
FROM v JOIN c ON v.user_id = c.user_id AND v.b = c.b
""")
def window_join_inner(spark, sf):
    v, c = _side(spark, sf, "view", "view"), _side(spark, sf, "click", "click")
    j = window_join(v, c, "user_id", "view_ts", "click_ts", WJ_SIZE_S, "inner")
    return j.select("user_id", "window_end", "view_id", "click_id")


@register("window_join_left", _WJ + f"""
SELECT v.user_id, (v.b + 1) * {WJ_SIZE_S * 1000} AS window_end, view_id, click_id
FROM v LEFT JOIN c ON v.user_id = c.user_id AND v.b = c.b
""")
def window_join_left(spark, sf):
    v, c = _side(spark, sf, "view", "view"), _side(spark, sf, "click", "click")
    j = window_join(v, c, "user_id", "view_ts", "click_ts", WJ_SIZE_S, "left")
    return j.select("user_id", "window_end", "view_id", "click_id")


def lookup_rows(spark):
    return from_rows(spark, [(i, n, f) for i, (n, f) in enumerate(LOOKUP_ROWS)], "pos int, name string, factor double")


# --- JN-5: lookup join, case-insensitive, first match wins, default row -------------------
@register("lookup_join", f"""
WITH l AS (SELECT * FROM (VALUES {_LOOKUP_VALUES}) t(pos, name, factor)),
d AS (SELECT lower(name) AS lk, arg_min(factor, pos) AS factor FROM l GROUP BY ALL)
SELECT e.event_id,
       CASE WHEN d.factor IS NULL THEN '{NO_MATCH_NAME}' ELSE e.event_type END AS name,
       CASE WHEN d.factor IS NULL THEN {NO_MATCH_AMOUNT} ELSE CAST(CAST(e.value AS DECIMAL(12, 2)) * CAST(d.factor AS DECIMAL(8, 2)) AS DOUBLE) END AS amount
FROM events e LEFT JOIN d ON lower(e.event_type) = d.lk
""")
def lookup_join(spark, sf):
    small = lookup_rows(spark)
    ev = load_events(spark, sf).select("event_id", "event_type", "value")
    j = lookup(ev, small, "event_type", "name", ["factor"], "pos")
    hit = F.col("factor").isNotNull()
    return j.select("event_id",
                    F.when(hit, F.col("event_type")).otherwise(F.lit(NO_MATCH_NAME)).alias("name"),
                    F.when(hit, (F.col("value").cast("decimal(12,2)") * F.col("factor").cast("decimal(8,2)"))
                           .cast("double"))
                    .otherwise(F.lit(NO_MATCH_AMOUNT)).alias("amount"))
