"""Pattern / detection analytics on ``events`` (PAT-1..9, PAT-7 + WIN-4).

Mapping onto the driver table: fail = ``error``; order create = ``click``,
pay = ``purchase``, order key = (user, UTC day); sensor reading = ``value``
per user. Event order within a key is ``(ts, event_id)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.patterns import (PAYED, Step, adjacent_pair, cap_per_key, followed_by_within,
                                         jump_alert, match_orders, n_in_a_row, order_verdict,
                                         rising_alert, sequence)
from tidepool.operators.windows import sliding_count
from tidepool.plans.registry import register
from tidepool.plans.sqlfrag import ITEM, US
from tidepool.sources.tables import load_events, load_table

ORDER = ["ts", "event_id"]
FAIL_WITHIN_S = 6 * 3600
SEQ_WITHIN_S = 9 * 3600  # PAT-2 has a bound of its own, half as long again as PAT-1's
N_FAIL, N_FAIL_WITHIN_S = 3, 48 * 3600
ORDER_LIMIT_S = 6 * 3600
CLICK_CAP = 3
JUMP = 40.0
RISE_S = 6 * 3600

# Output messages of the detection jobs.
MSG_LOGIN_STATE = "login fail in {} seconds."
MSG_LOGIN_SEQ = "login fail!"
MSG_LOGIN_N = "login fail in {} seconds for {} times."
MSG_CLICK_CAP = "Click over {} times today."
MSG_RISE = " 温度连续上升"

_W = "PARTITION BY user_id ORDER BY ts, event_id"
_DAY_MS = "epoch_ms(date_trunc('day', ts))"


def _day(df):
    return df.withColumn("day_ms", F.unix_millis(F.date_trunc("day", "ts")))


# --- PAT-1: consecutive fails (state form) --------------------------------------------
@register("login_fail_state", f"""
WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  lag(event_type) OVER ({_W}) AS pt, lag(epoch_us(ts)) OVER ({_W}) AS pts,
                  lag(event_id) OVER ({_W}) AS pid
           FROM events)
SELECT user_id, pid AS first_event_id, event_id AS last_event_id, pts // 1000 AS first_fail_ms,
       t // 1000 AS last_fail_ms, '{MSG_LOGIN_STATE.format(FAIL_WITHIN_S)}' AS msg
FROM s WHERE event_type = 'error' AND pt = 'error' AND t - pts < {FAIL_WITHIN_S * US}
""")
def login_fail_state(spark, sf):
    ev = load_events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    r = adjacent_pair(ev, "user_id", ORDER, "ts", "event_type", "error", "error", FAIL_WITHIN_S)
    return r.withColumn("msg", F.lit(MSG_LOGIN_STATE.format(FAIL_WITHIN_S)))


# --- PAT-2: strict sequence fail next fail within the bound -----------------------------
@register("login_fail_seq", f"""
WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  lag(event_type) OVER ({_W}) AS pt, lag(epoch_us(ts)) OVER ({_W}) AS pts,
                  lag(event_id) OVER ({_W}) AS pid
           FROM events)
SELECT user_id, pid AS first_event_id, event_id AS last_event_id, pts // 1000 AS first_fail_ms,
       t // 1000 AS last_fail_ms, '{MSG_LOGIN_SEQ}' AS msg
FROM s WHERE event_type = 'error' AND pt = 'error' AND t - pts < {SEQ_WITHIN_S * US}
""")
def login_fail_seq(spark, sf):
    ev = load_events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    r = adjacent_pair(ev, "user_id", ORDER, "ts", "event_type", "error", "error", SEQ_WITHIN_S)
    return r.withColumn("msg", F.lit(MSG_LOGIN_SEQ))


# --- PAT-3: N fails in a row within a bound ----------------------------------------------
@register("n_failures", f"""
WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
                      OVER ({_W} ROWS BETWEEN {N_FAIL - 1} PRECEDING AND CURRENT ROW) AS nf,
                  lag(epoch_us(ts), {N_FAIL - 1}) OVER ({_W}) AS t0,
                  lag(event_id, {N_FAIL - 1}) OVER ({_W}) AS id0
           FROM events)
SELECT user_id, id0 AS first_event_id, event_id AS last_event_id, t0 // 1000 AS first_fail_ms,
       t // 1000 AS last_fail_ms, '{MSG_LOGIN_N.format(N_FAIL_WITHIN_S, N_FAIL)}' AS msg
FROM s WHERE nf = {N_FAIL} AND t0 IS NOT NULL AND t - t0 < {N_FAIL_WITHIN_S * US}
""")
def n_failures(spark, sf):
    ev = load_events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    r = n_in_a_row(ev, "user_id", ORDER, "ts", "event_type", "error", N_FAIL, N_FAIL_WITHIN_S)
    return r.withColumn("msg", F.lit(MSG_LOGIN_N.format(N_FAIL_WITHIN_S, N_FAIL)))


# --- PAT-4: create followed by pay within the limit, timeouts tagged --------------------
@register("order_timeout_seq", f"""
WITH s AS (SELECT user_id, {_DAY_MS} AS day_ms, event_id, event_type, epoch_us(ts) AS t,
                  min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) OVER (
                      PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
           FROM events)
SELECT user_id, day_ms, event_id AS create_event_id,
       CASE WHEN np IS NOT NULL AND np - t < {ORDER_LIMIT_S * US} THEN 'payed successfully'
            ELSE 'timeout' END AS result
FROM s WHERE event_type = 'click'
""")
def order_timeout_seq(spark, sf):
    ev = _day(load_events(spark, sf).select("event_id", "user_id", "ts", "event_type"))
    r = followed_by_within(ev, ["user_id", "day_ms"], ORDER, "ts", "event_type", "click",
                           "purchase", ORDER_LIMIT_S, ["event_id"])
    return r.select("user_id", "day_ms", F.col("start.event_id").alias("create_event_id"),
                    F.when(F.col("status") == "matched", PAYED).otherwise("timeout").alias("result"))


# --- PAT-2 in general: view, the next event a click, later a purchase, within the bound ----
BUY_WITHIN_S = 24 * 3600
_AFTER = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"


@register("browse_buy_sequence", f"""
WITH s AS (SELECT user_id, event_id, ts, event_type, epoch_us(ts) AS t, lead(event_type) OVER ({_W}) AS et2,
                  lead(event_id) OVER ({_W}) AS id2, lead(epoch_us(ts)) OVER ({_W}) AS t2,
                  min(CASE WHEN event_type = 'purchase' THEN (epoch_us(ts), event_id) END) OVER ({_AFTER}) AS buy
           FROM events),
c AS (SELECT *, lead(buy) OVER ({_W}) AS buy2 FROM s),
j AS (SELECT user_id, event_id AS view_id, t, id2, et2, t2 - t < {BUY_WITHIN_S * US} AS in2, buy2[2] AS id3,
             coalesce(buy2[1] - t < {BUY_WITHIN_S * US}, FALSE) AS in3
      FROM c WHERE event_type = 'view')
SELECT user_id, view_id, CASE WHEN in2 THEN id2 END AS click_id, CASE WHEN in2 AND in3 THEN id3 END AS purchase_id,
       CASE WHEN in2 AND in3 THEN 'matched' ELSE 'timeout' END AS status
FROM j WHERE NOT coalesce(in2 AND et2 <> 'click', FALSE)
""")
def browse_buy_sequence(spark, sf):
    ev = load_events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    return browse_buy(sequence(ev, ["user_id"], ORDER, "ts", browse_buy_steps(), BUY_WITHIN_S, ["event_id"]))


def browse_buy_steps():
    kind = F.col("event_type")
    return [Step("view", kind == "view"), Step("click", kind == "click", strict=True), Step("purchase", kind == "purchase")]


def browse_buy(found):
    return found.select("user_id", F.col("view.event_id").alias("view_id"), F.col("click.event_id").alias("click_id"),
                        F.col("purchase.event_id").alias("purchase_id"), "status")


_FIRSTS = f"""
WITH f AS (SELECT user_id, {_DAY_MS} AS day_ms,
                  min(CASE WHEN event_type = 'click' THEN epoch_us(ts) END) AS c,
                  arg_min(CASE WHEN event_type = 'click' THEN event_id END,
                          CASE WHEN event_type = 'click' THEN (epoch_us(ts), event_id) END) AS ci,
                  min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS p,
                  arg_min(CASE WHEN event_type = 'purchase' THEN event_id END,
                          CASE WHEN event_type = 'purchase' THEN (epoch_us(ts), event_id) END) AS pi
           FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL)
"""


# --- PAT-5: order / payment matcher, four outcomes ----------------------------------------
@register("order_match", _FIRSTS + f"""
SELECT user_id, day_ms,
       CASE WHEN c IS NOT NULL AND p IS NOT NULL AND p < c + {ORDER_LIMIT_S * US} THEN 'payed successfully'
            WHEN c IS NOT NULL AND p IS NOT NULL THEN 'payed but already timeout'
            WHEN c IS NOT NULL THEN 'order timeout'
            ELSE 'already payed but not found create log' END AS result
FROM f
""")
def order_match(spark, sf):
    ev = _day(load_events(spark, sf).where(F.col("event_type").isin("click", "purchase"))
              .select("event_id", "user_id", "ts", "event_type"))
    return match_orders(ev, ["user_id", "day_ms"], "ts", "event_type", "click", "purchase",
                        ORDER_LIMIT_S)


# --- PAT-6: verdict at create + limit ------------------------------------------------------
@register("order_verdict", _FIRSTS + f"""
SELECT user_id, day_ms,
       CASE WHEN p IS NOT NULL AND p <= c + {ORDER_LIMIT_S * US} THEN 'order payed successfully'
            ELSE 'order timeout' END AS result
FROM f WHERE c IS NOT NULL AND NOT (p IS NOT NULL AND (p < c OR (p = c AND pi < ci)))
""")
def order_verdict_q(spark, sf):
    ev = _day(load_events(spark, sf).where(F.col("event_type").isin("click", "purchase"))
              .select("event_id", "user_id", "ts", "event_type"))
    return order_verdict(ev, ["user_id", "day_ms"], "ts", "event_type", "click", "purchase",
                         ORDER_LIMIT_S)


# --- PAT-7: click cap per (user, item, UTC day) ----------------------------------------------------
_CAP_SQL = f"""
WITH r AS (SELECT event_id, user_id, {ITEM} AS item_id, {_DAY_MS} AS day_ms, ts,
                  row_number() OVER (PARTITION BY user_id, {ITEM}, date_trunc('day', ts)
                                     ORDER BY ts, event_id) AS click_no
           FROM events WHERE event_type = 'click')
"""


def _capped(spark, sf):
    clicks = _day(load_events(spark, sf).where(F.col("event_type") == "click")
                  .select("event_id", "user_id", "item_id", "ts"))
    return cap_per_key(clicks, ["user_id", "item_id", "day_ms"], ORDER, CLICK_CAP)


@register("click_cap_pass", _CAP_SQL + f"""
SELECT event_id, user_id, item_id, day_ms, click_no FROM r WHERE click_no <= {CLICK_CAP}
""")
def click_cap_pass(spark, sf):
    return (_capped(spark, sf).where(F.col("click_no") <= CLICK_CAP)
            .select("event_id", "user_id", "item_id", "day_ms", "click_no"))


@register("click_cap_warn", _CAP_SQL + f"""
SELECT user_id, item_id, day_ms, event_id AS blocked_event_id, '{MSG_CLICK_CAP.format(CLICK_CAP)}' AS msg
FROM r WHERE click_no = {CLICK_CAP + 1}
""")
def click_cap_warn(spark, sf):
    return (_capped(spark, sf).where(F.col("click_no") == CLICK_CAP + 1)
            .select("user_id", "item_id", "day_ms", F.col("event_id").alias("blocked_event_id"),
                    F.lit(MSG_CLICK_CAP.format(CLICK_CAP)).alias("msg")))


# --- PAT-7 then WIN-4: capped clicks per nation, 1 h / 5 s (fan-out 720) ------------------
@register("region_clicks", _CAP_SQL + f""",
p AS (SELECT r.ts, n.n_name AS nation, epoch_us(r.ts) AS t FROM r
      JOIN customer c ON c.c_custkey = r.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey
      WHERE click_no <= {CLICK_CAP}),
w AS (SELECT nation, (t // {5 * US} - k) * {5 * US} AS ws FROM p, range(0, 720) r(k))
SELECT nation, (ws + {3600 * US}) // 1000 AS window_end,
       strftime(make_timestamp(ws + {3600 * US}), '%Y-%m-%d %H:%M:%S') AS window_end_text,
       count(*) AS cnt
FROM w GROUP BY ALL
""")
def region_clicks(spark, sf):
    passed = _capped(spark, sf).where(F.col("click_no") <= CLICK_CAP)
    cust = load_table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    geo = passed.join(cust, on="user_id").select("ts", "c_nationkey")
    # aggregate on the narrow integer key; names are attached to the (much smaller) result
    w = sliding_count(geo, "ts", ["c_nationkey"], 3600, 5)
    nation = load_table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return w.join(nation, on="c_nationkey").select(
        "nation", "window_end",
        F.date_format(F.timestamp_millis("window_end"), "yyyy-MM-dd HH:mm:ss").alias("window_end_text"),
        "cnt")


# --- PAT-8: jump alert -----------------------------------------------------------------------
@register("jump_alert", f"""
SELECT user_id, event_id, prev_value, value FROM (
  SELECT user_id, event_id, value, lag(value) OVER ({_W}) AS prev_value FROM events)
WHERE abs(value - prev_value) > {JUMP}
""")
def jump_alert_q(spark, sf):
    ev = load_events(spark, sf).select("event_id", "user_id", "ts", "value")
    return jump_alert(ev, "user_id", ORDER, "ts", "value", JUMP).select(
        "user_id", "event_id", "prev_value", "value")


# --- PAT-9: continuous rise alert ---------------------------------------------------------------
@register("rising_alert", f"""
WITH a AS (SELECT user_id, event_id, ts, epoch_us(ts) AS t, value,
                  lag(value) OVER ({_W}) AS pv FROM events),
b AS (SELECT *, sum(CASE WHEN pv IS NULL OR value < pv THEN 1 ELSE 0 END)
                    OVER ({_W} ROWS UNBOUNDED PRECEDING) AS run_id FROM a),
r AS (SELECT user_id, run_id, min(t) AS run_start,
             min(CASE WHEN value > pv THEN t END) AS first_rise FROM b GROUP BY ALL)
SELECT r.user_id, r.first_rise // 1000 AS rise_start_ms,
       (r.first_rise + {RISE_S * US}) // 1000 AS alert_ms,
       CAST(r.user_id AS VARCHAR) || '{MSG_RISE}' AS msg
FROM r LEFT JOIN r n ON n.user_id = r.user_id AND n.run_id = r.run_id + 1
WHERE r.first_rise IS NOT NULL AND (n.run_start IS NULL OR n.run_start > r.first_rise + {RISE_S * US})
""")
def rising_alert_q(spark, sf):
    ev = load_events(spark, sf).select("event_id", "user_id", "ts", "value")
    r = rising_alert(ev, "user_id", ORDER, "ts", "value", RISE_S)
    return r.withColumn("msg", F.concat(F.col("user_id").cast("string"), F.lit(MSG_RISE)))
