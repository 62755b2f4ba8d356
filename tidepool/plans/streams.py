"""Streaming twins: the batch analytics run as Structured Streaming queries.

``events`` (filtered as the batch query does) is staged as time-ordered slices
under the checkpoint folder and replayed one slice per micro-batch with
``availableNow``. Results are read back as a batch DataFrame.

Windows, sessions, days, joins and deadlines are closed at the end of the input
(``events_stream(close=True)``), so every oracle is the whole batch answer.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.functions.text import ASCII_SPACE, tokenize
from tidepool.operators.aggregates import payment_totals
from tidepool.operators.patterns import ORDER_PAYED, ORDER_TIMEOUT, PAYED, Step, four_outcomes
from tidepool.plans import joins, patterns  # noqa: F401  (their SQL is used below)
from tidepool.plans.registry import ORACLE, register
from tidepool.sources.parse import parse_pay_result
from tidepool.sources.tables import load_table
from tidepool.sources.text import stream_lines
from tidepool.plans.sqlfrag import ITEM, US, ev, sliding
from tidepool.streaming.runner import events_stream, run_append, run_foreach_batch
from tidepool.streaming.stateful import (ClickCapProcessor, CountWindowProcessor,
                                         CumulativeWindowProcessor, EveryNthProcessor,
                                         RisingProcessor, RollingReduceProcessor,
                                         RunningSumProcessor, SlidingCountProcessor,
                                         WindowRunningCountProcessor, flat_map_with_state, jump,
                                         matched_span, run_ordered, sequence_stream)
from tidepool.streaming.windows import (rank_batches, stream_uv_exact, stream_uv_running,
                                        stream_window_agg, version_batches)

FAIL_WITHIN_S = 6 * 3600
RISE_S = 6 * 3600
ORDER_LIMIT_S = 6 * 3600
SESSION_GAP_S = 6 * 3600
CLICK_CAP = 3
JUMP = 40.0
BAND_S = 30 * 60


def _read(spark, path):
    return spark.read.parquet(path)


# --- WIN-4 + TOP-1 on a stream (pane chain + per-batch ranking) -------------------------
@register("stream_hot_items", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 3600, 300, "item_id")}),
c AS (SELECT item_id, (ws + {3600 * US}) // 1000 AS window_end, count(*) AS view_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id)
      AS top_rank FROM c)
SELECT window_end, item_id, view_count, top_rank FROM r
WHERE top_rank <= 3
""")
def stream_hot_items(spark, sf):
    sdf, base = events_stream(spark, sf, "hot_items", where=F.col("event_type") == "view", close=True)
    counts = stream_window_agg(sdf, "ts", 3600, 300, ["item_id"],
                               {"view_count": ("count", None)}, panes=True)
    run_foreach_batch(counts, rank_batches(f"{base}/out", ["window_end"], "view_count",
                                           ["item_id"], 3), f"{base}/ckpt")
    return _read(spark, f"{base}/out").select("window_end", "item_id", "view_count", "top_rank")


# --- WIN-5 on a stream: sliding min 10 s / 3 s ------------------------------------------------
@register("stream_sliding_min", f"""
WITH w AS ({sliding(ev(), 10, 3, "user_id, value")})
SELECT * FROM (
  SELECT user_id, ws // 1000 AS window_start, (ws + {10 * US}) // 1000 AS window_end,
         min(value) AS min_value
  FROM w GROUP BY ALL)
""")
def stream_sliding_min(spark, sf):
    sdf, base = events_stream(spark, sf, "sliding_min", close=True)
    out = stream_window_agg(sdf, "ts", 10, 3, ["user_id"], {"min_value": ("min", "value")},
                            panes=True)
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- AGG-8 on a stream ------------------------------------------------------------------------
@register("stream_uv_hourly", f"""
SELECT * FROM (
  SELECT (t // {3600 * US} + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS uv
  FROM ({ev("event_type = 'view'")}) GROUP BY ALL)
""")
def stream_uv_hourly(spark, sf):
    sdf, base = events_stream(spark, sf, "uv", where=F.col("event_type") == "view", close=True)
    run_append(stream_uv_exact(sdf, "ts", "user_id", 3600), f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- AGG-9 on a stream: the running distinct count, every emitted version, beside the exact one ------
# Batches are the weeks of the input, so which versions there are is known.
WEEK_S = 7 * 86400


@register("stream_uv_approx", f"""
WITH v AS (SELECT *, t // {WEEK_S * US} AS week FROM ({sliding(ev("event_type = 'view'"), 48 * 3600, 86400, "user_id, t")})),
e AS (SELECT DISTINCT ws, week FROM v)
SELECT e.week, (e.ws + {48 * 3600 * US}) // 1000 AS window_end, count(DISTINCT v.user_id) AS uv_sketch, count(DISTINCT v.user_id) AS uv
FROM e JOIN v ON v.ws = e.ws AND v.week <= e.week GROUP BY e.week, e.ws
""")
def stream_uv_approx_q(spark, sf):
    from tidepool.operators.windows import assign_windows
    from tidepool.sources.tables import load_events

    week = F.floor(F.unix_seconds("ts") / WEEK_S)
    sdf, base = events_stream(spark, sf, "uv_approx", where=F.col("event_type") == "view", slice_by=week)
    run_foreach_batch(stream_uv_running(sdf, "ts", "user_id", 48 * 3600, 86400), version_batches(f"{base}/out"), f"{base}/ckpt", mode="update")
    views = assign_windows(load_events(spark, sf).where(F.col("event_type") == "view").select("ts", "user_id", week.alias("week")), "ts", 48 * 3600, 86400)
    # batches without rows write nothing, so the k-th batch is the k-th week that has views
    weeks = views.select("week").distinct().withColumn("batch_id", (F.row_number().over(Window.orderBy("week")) - 1).cast("int"))
    versions = _read(spark, f"{base}/out").join(weeks, "batch_id").select("week", "window_end", "uv_sketch")
    first = views.groupBy("window_end", "user_id").agg(F.min("week").alias("first_week"))
    exact = versions.join(first, "window_end").where(F.col("first_week") <= F.col("week")).groupBy("week", "window_end").agg(F.count(F.lit(1)).alias("uv"))
    return versions.join(exact, ["week", "window_end"], "full")


_W = "PARTITION BY user_id ORDER BY ts, event_id"


# --- PAT-1 on a stream (event-ordered keyed state) ----------------------------------------------
@register("stream_login_fail", f"""
WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  lag(event_type) OVER ({_W}) AS pt, lag(epoch_us(ts)) OVER ({_W}) AS pts,
                  lag(event_id) OVER ({_W}) AS pid
           FROM events)
SELECT user_id, pid AS first_event_id, event_id AS last_event_id, pts // 1000 AS first_fail_ms,
       t // 1000 AS last_fail_ms
FROM s WHERE event_type = 'error' AND pt = 'error' AND t - pts < {FAIL_WITHIN_S * US}
""")
def stream_login_fail(spark, sf):
    return _fails(spark, sf, "login_fail", 2, FAIL_WITHIN_S)


def _fails(spark, sf, name, n, within_s, delay_s=0):
    """``n`` fails in a row (a strict sequence) within the bound."""
    sdf, base = events_stream(spark, sf, name, close={"user_id": -1} if delay_s else False, late_s=delay_s)
    steps = [Step(f"s{i}", F.col("event_type") == "error", strict=i > 0) for i in range(n)]
    found = sequence_stream(sdf, "user_id", "ts", "event_id", steps, within_s, delay_s)
    run_append(matched_span(found, "user_id", "s0", f"s{n - 1}"), f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-8 on a stream ----------------------------------------------------------------------------
@register("stream_jump_alert", f"""
SELECT user_id, event_id, prev_value, value FROM (
  SELECT user_id, event_id, value, epoch_us(ts) AS t, lag(value) OVER ({_W}) AS prev_value
  FROM events)
WHERE abs(value - prev_value) > {JUMP}
""")
def stream_jump_alert(spark, sf):
    sdf, base = events_stream(spark, sf, "jump")
    out = flat_map_with_state(sdf, "user_id", "ts", "event_id", {"value": "double"}, jump(JUMP), "value double",
                              "event_id long, prev_value double, value double")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-7 on a stream: passed clicks and warnings, tagged -------------------------------------------
@register("stream_click_cap", f"""
WITH r AS (SELECT event_id, user_id, {ITEM} AS item_id, epoch_ms(date_trunc('day', ts)) AS day_ms, epoch_us(ts) AS t,
                  row_number() OVER (PARTITION BY user_id, {ITEM}, date_trunc('day', ts)
                                     ORDER BY ts, event_id) AS click_no
           FROM events WHERE event_type = 'click')
SELECT user_id, item_id, event_id, day_ms, click_no,
       CASE WHEN click_no <= {CLICK_CAP} THEN 'pass' ELSE 'warn' END AS kind
FROM r WHERE click_no <= {CLICK_CAP + 1}
""")
def stream_click_cap(spark, sf):
    sdf, base = events_stream(spark, sf, "click_cap", where=F.col("event_type") == "click")
    sdf = sdf.withColumn("day_ms", F.unix_millis(F.date_trunc("day", "ts")))
    out = run_ordered(sdf, ["user_id", "item_id"], "ts", "event_id", ["day_ms"], ClickCapProcessor(CLICK_CAP),
                      "user_id long, item_id long, event_id long, day_ms long, click_no long, kind string")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- JN-1 on streams: stream-stream interval join with watermarks -----------------------------------
@register("stream_interval_join", f"""
WITH p AS (SELECT user_id, event_id AS purchase_id, epoch_us(ts) AS pt FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, event_id AS click_id, epoch_us(ts) AS ct FROM events WHERE event_type = 'click')
SELECT p.user_id, purchase_id, click_id, pt // 1000 AS purchase_ms, ct // 1000 AS click_ms
FROM p JOIN c ON p.user_id = c.user_id AND c.ct BETWEEN p.pt - {BAND_S * US} AND p.pt + {BAND_S * US}
""")
def stream_interval_join(spark, sf):
    ps, base = events_stream(spark, sf, "ij_p", where=F.col("event_type") == "purchase")
    cs, _ = events_stream(spark, sf, "ij_c", where=F.col("event_type") == "click")
    p = ps.select(F.col("user_id").alias("p_user"), F.col("event_id").alias("purchase_id"),
                  F.col("ts").alias("pts")).withWatermark("pts", "0 seconds")
    c = cs.select(F.col("user_id").alias("c_user"), F.col("event_id").alias("click_id"),
                  F.col("ts").alias("cts")).withWatermark("cts", "0 seconds")
    cond = ((F.col("p_user") == F.col("c_user"))
            & (F.col("cts") >= F.col("pts") - F.expr(f"INTERVAL {BAND_S} SECONDS"))
            & (F.col("cts") <= F.col("pts") + F.expr(f"INTERVAL {BAND_S} SECONDS")))
    j = p.join(c, cond, "inner").select(F.col("p_user").alias("user_id"), "purchase_id", "click_id",
                                        F.unix_millis("pts").alias("purchase_ms"),
                                        F.unix_millis("cts").alias("click_ms"))
    run_append(j, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- AGG-2 on a stream: update-mode running counts; final value per key -------------------------------
@register("stream_running_count", """
SELECT user_id, count(*) AS cnt FROM events GROUP BY ALL
""")
def stream_running_count(spark, sf):
    sdf, base = events_stream(spark, sf, "running_count")
    counts = sdf.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    run_foreach_batch(counts, sink, f"{base}/ckpt", mode="update")
    upd = _read(spark, f"{base}/out")
    return upd.groupBy("user_id").agg(F.max("cnt").alias("cnt"))


def _ordered(spark, sf, name, processor, out_schema, payload=("value",), where=None, close=False):
    sdf, base = events_stream(spark, sf, name, where=where, close=close)
    out = run_ordered(sdf, "user_id", "ts", "event_id", list(payload), processor, out_schema)
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-9 on a stream: rise alert with an event-time deadline ---------------------------------
@register("stream_rising_alert", f"""
WITH a AS (SELECT user_id, event_id, ts, epoch_us(ts) AS t, value,
                  lag(value) OVER ({_W}) AS pv FROM events),
b AS (SELECT *, sum(CASE WHEN pv IS NULL OR value < pv THEN 1 ELSE 0 END)
                    OVER ({_W} ROWS UNBOUNDED PRECEDING) AS run_id FROM a),
r AS (SELECT user_id, run_id, min(t) AS run_start,
             min(CASE WHEN value > pv THEN t END) AS first_rise FROM b GROUP BY ALL)
SELECT r.user_id, r.first_rise // 1000 AS rise_start_ms,
       (r.first_rise + {RISE_S * US}) // 1000 AS alert_ms
FROM r LEFT JOIN r n ON n.user_id = r.user_id AND n.run_id = r.run_id + 1
WHERE r.first_rise IS NOT NULL AND (n.run_start IS NULL OR n.run_start > r.first_rise + {RISE_S * US})
""")
def stream_rising_alert(spark, sf):
    return _ordered(spark, sf, "rising", RisingProcessor(RISE_S),
                    "user_id long, rise_start_ms long, alert_ms long", close=True)


# --- WIN-12 on a stream: count window of 5 rows, min ----------------------------------------------
@register("stream_count_window_min", f"""
WITH r AS (SELECT user_id, value, epoch_us(ts) AS t,
                  (row_number() OVER ({_W}) - 1) // 5 + 1 AS window_no FROM events)
SELECT user_id, window_no, min_value FROM (
  SELECT user_id, window_no, min(value) AS min_value, count(*) AS n, max(t) AS last_t
  FROM r GROUP BY ALL)
WHERE n = 5
""")
def stream_count_window_min(spark, sf):
    return _ordered(spark, sf, "count_window", CountWindowProcessor(5),
                    "user_id long, window_no long, min_value double")


# --- WIN-13 on a stream: every 2 rows, sum of the last 10 -------------------------------------------
@register("stream_count_window_sliding_sum", f"""
WITH r AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER ({_W}) AS row_no,
                  sum(value) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s
           FROM events)
SELECT user_id, row_no, round(s, 2) AS sum_value FROM r
WHERE row_no % 2 = 0
""")
def stream_count_window_sliding_sum(spark, sf):
    return _ordered(spark, sf, "count_window_sliding", SlidingCountProcessor(10, 2),
                    "user_id long, row_no long, sum_value double")


# --- WIN-15 on a stream: every 3rd event of a user ----------------------------------------------------
@register("stream_every_nth", f"""
SELECT user_id, event_id, row_no FROM (
  SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER ({_W}) AS row_no FROM events)
WHERE row_no % 3 = 0
""")
def stream_every_nth(spark, sf):
    return _ordered(spark, sf, "every_nth", EveryNthProcessor(3),
                    "user_id long, event_id long, row_no long")


# --- AGG-6 on a stream: rolling reduce per event -------------------------------------------------------
@register("stream_rolling_reduce", f"""
SELECT user_id, event_id, reduced_ts_s, reduced_value FROM (
  SELECT event_id, user_id, epoch_us(ts) AS t,
         first_value(CAST(floor(epoch(ts)) AS BIGINT)) OVER ({_W}) + row_number() OVER ({_W}) - 1
             AS reduced_ts_s,
         CASE WHEN row_number() OVER ({_W}) = 1 THEN value ELSE value + 10 END AS reduced_value
  FROM events)
""")
def stream_rolling_reduce(spark, sf):
    return _ordered(spark, sf, "rolling_reduce", RollingReduceProcessor(),
                    "user_id long, event_id long, reduced_ts_s long, reduced_value double")


# --- WIN-14 on a stream: session windows, emitted when the gap has passed the watermark ---------------
@register("stream_session_counts", f"""
WITH g AS (SELECT user_id, t, event_id,
                  CASE WHEN lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id)
                       > t - {SESSION_GAP_S * US} THEN 0 ELSE 1 END AS new_s
           FROM ({ev()})),
s AS (SELECT user_id, t, sum(new_s) OVER (PARTITION BY user_id ORDER BY t, event_id) AS sid FROM g)
SELECT * FROM (
  SELECT user_id, min(t) // 1000 AS session_start,
         (max(t) + {SESSION_GAP_S * US}) // 1000 AS session_end, count(*) AS cnt
  FROM s GROUP BY user_id, sid)
""")
def stream_session_counts(spark, sf):
    sdf, base = events_stream(spark, sf, "sessions", close=True)
    out = (sdf.withWatermark("ts", "0 seconds")
              .groupBy("user_id", F.session_window("ts", f"{SESSION_GAP_S} seconds").alias("s"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select("user_id", F.unix_millis("s.start").alias("session_start"),
                      F.unix_millis("s.end").alias("session_end"), "cnt"))
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-5 on a stream: one verdict per (user, day) once the day has closed --------------------------
@register("stream_order_match", ORACLE["order_match"])
def stream_order_match(spark, sf):
    sdf, base = events_stream(spark, sf, "order_match",
                              where=F.col("event_type").isin("click", "purchase"), close=True)
    t = F.unix_micros("ts")
    day = (sdf.withWatermark("ts", "0 seconds")
              .groupBy("user_id", F.window("ts", "1 day").alias("d"))
              .agg(F.min(F.when(F.col("event_type") == "click", t)).alias("c"),
                   F.min(F.when(F.col("event_type") == "purchase", t)).alias("p")))
    c, p = F.col("c"), F.col("p")
    res = four_outcomes(c, p, ORDER_LIMIT_S * US)
    out = day.select("user_id", F.unix_millis("d.start").alias("day_ms"), res.alias("result"))
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


def _final_updates(spark, sdf_counts, base, keys, value):
    """Run an update-mode aggregate; per-batch folders; last value per key."""

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    run_foreach_batch(sdf_counts, sink, f"{base}/ckpt", mode="update")
    upd = _read(spark, f"{base}/out")
    return (upd.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value)))


# --- SRC-3 + PRJ-6 + AGG-2 on a stream: running word counts over a landing folder of text files ----
@register("stream_word_count", """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM documents)
WHERE length(word) > 0 GROUP BY word
""")
def stream_word_count(spark, sf):
    from tidepool.streaming.runner import scratch

    base = scratch(spark, "word_count")
    docs = load_table(spark, sf, "documents").select("doc_id", "text")
    # land the documents as text files (line breaks are whitespace, so counts are unchanged)
    docs.select("text").write.mode("ignore").text(f"{base}/landing")
    lines = stream_lines(spark, f"{base}/landing", max_files_per_trigger=1000)
    counts = tokenize(lines, "value", ASCII_SPACE).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    return _final_updates(spark, counts, base, ["word"], "cnt")


# --- PRJ-4 + AGG-3 on a stream: payment totals over JSON result lines --------------------------------
@register("stream_payment_totals", """
WITH p AS (
SELECT CASE WHEN event_type = 'purchase' THEN '0000' ELSE '0001' END AS bussinessRst,
       value AS chargefee, CAST(event_id AS VARCHAR) AS requestId,
       strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST((epoch_us(ts) // 1000 % 1000) AS VARCHAR), 3, '0')
           AS receiveNotifyTime
FROM events)
SELECT count(*) AS all_orders, count(*) FILTER (WHERE bussinessRst = '0000') AS success_orders,
       CAST(sum(CAST(chargefee AS DECIMAL(12, 2))) FILTER (WHERE bussinessRst = '0000') AS DOUBLE)
           AS success_money,
       arg_max(receiveNotifyTime, (receiveNotifyTime, requestId))
           FILTER (WHERE bussinessRst = '0000') AS last_success_time
FROM p
""")
def stream_payment_totals(spark, sf):
    from tidepool.plans.basics import _pay_lines

    sdf, base = events_stream(spark, sf, "payments")
    p = parse_pay_result(_pay_lines(sdf))
    ok = F.col("bussinessRst") == "0000"
    totals = payment_totals(p, ok, F.col("chargefee"), F.struct("receiveNotifyTime", "requestId"),
                            "receiveNotifyTime").withColumn("_k", F.lit(0))

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    run_foreach_batch(totals, sink, f"{base}/ckpt", mode="complete")
    out = _read(spark, f"{base}/out")
    last = out.agg(F.max("batch_id").alias("b"))
    return out.join(last, out.batch_id == last.b).select(
        "all_orders", "success_orders", "success_money", "last_success_time")


# --- WIN-1 on a stream: hourly page views -----------------------------------------------------------
@register("stream_pv_hourly", f"""
SELECT * FROM (
  SELECT (t // {3600 * US} + 1) * 3600000 AS window_end, count(*) AS pv
  FROM ({ev("event_type = 'view'")}) GROUP BY ALL)
""")
def stream_pv_hourly(spark, sf):
    sdf, base = events_stream(spark, sf, "pv", where=F.col("event_type") == "view", close=True)
    out = stream_window_agg(sdf, "ts", 3600, None, [], {"pv": ("count", None)})
    run_append(out.select("window_end", "pv"), f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- JN-3 on streams: views and clicks of a user in the same hour (stream-stream) ---------------------
@register("stream_window_join_inner", f"""
WITH v AS (SELECT user_id, event_id AS view_id, epoch_us(ts) // {3600 * US} AS b
           FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id AS click_id, epoch_us(ts) // {3600 * US} AS b
      FROM events WHERE event_type = 'click')
SELECT v.user_id, (v.b + 1) * 3600000 AS window_end, view_id, click_id
FROM v JOIN c ON v.user_id = c.user_id AND v.b = c.b
""")
def stream_window_join_inner(spark, sf):
    vs, base = events_stream(spark, sf, "wj_v", where=F.col("event_type") == "view")
    cs, _ = events_stream(spark, sf, "wj_c", where=F.col("event_type") == "click")
    v = (vs.withWatermark("ts", "0 seconds")
           .select(F.col("user_id").alias("v_user"), F.col("event_id").alias("view_id"),
                   F.window("ts", "1 hour").alias("vw")))
    c = (cs.withWatermark("ts", "0 seconds")
           .select(F.col("user_id").alias("c_user"), F.col("event_id").alias("click_id"),
                   F.window("ts", "1 hour").alias("cw")))
    j = v.join(c, (F.col("v_user") == F.col("c_user")) & (F.col("vw") == F.col("cw")), "inner")
    out = j.select(F.col("v_user").alias("user_id"), F.unix_millis("vw.end").alias("window_end"),
                   "view_id", "click_id")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- JN-5 on a stream: stream-static lookup, the planner chooses the join; same answer as lookup_join -----
def _lookup_sql():
    from tidepool.plans.registry import ORACLE
    import tidepool.plans.joins  # noqa: F401  (registers lookup_join)

    return ORACLE["lookup_join"]


@register("stream_lookup_join", _lookup_sql())
def stream_lookup_join(spark, sf):
    from tidepool.operators.joins import lookup
    from tidepool.plans import joins as J

    small = J.lookup_rows(spark)
    sdf, base = events_stream(spark, sf, "lookup")
    j = lookup(sdf.select("event_id", "event_type", "value"), small, "event_type", "name",
               ["factor"], "pos")
    hit = F.col("factor").isNotNull()
    out = j.select("event_id",
                   F.when(hit, F.col("event_type")).otherwise(F.lit(J.NO_MATCH_NAME)).alias("name"),
                   F.when(hit, (F.col("value").cast("decimal(12,2)")
                                * F.col("factor").cast("decimal(8,2)")).cast("double"))
                   .otherwise(F.lit(J.NO_MATCH_AMOUNT)).alias("amount"))
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-6 on a stream: verdict per (user, day) once the day has closed ---------------------------------
@register("stream_order_verdict", f"""
WITH f AS (SELECT user_id, epoch_ms(date_trunc('day', ts)) AS day_ms,
                  min(CASE WHEN event_type = 'click' THEN epoch_us(ts) END) AS c,
                  arg_min(CASE WHEN event_type = 'click' THEN event_id END,
                          CASE WHEN event_type = 'click' THEN (epoch_us(ts), event_id) END) AS ci,
                  min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS p,
                  arg_min(CASE WHEN event_type = 'purchase' THEN event_id END,
                          CASE WHEN event_type = 'purchase' THEN (epoch_us(ts), event_id) END) AS pi
           FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL)
SELECT user_id, day_ms,
       CASE WHEN p IS NOT NULL AND p <= c + {ORDER_LIMIT_S * US} THEN 'order payed successfully'
            ELSE 'order timeout' END AS result
FROM f WHERE c IS NOT NULL AND NOT (p IS NOT NULL AND (p < c OR (p = c AND pi < ci)))
""")
def stream_order_verdict(spark, sf):
    sdf, base = events_stream(spark, sf, "order_verdict",
                              where=F.col("event_type").isin("click", "purchase"), close=True)
    st = F.struct(F.unix_micros("ts").alias("t"), F.col("event_id").alias("i"))
    day = (sdf.withWatermark("ts", "0 seconds")
              .groupBy("user_id", F.window("ts", "1 day").alias("d"))
              .agg(F.min(F.when(F.col("event_type") == "click", st)).alias("c"),
                   F.min(F.when(F.col("event_type") == "purchase", st)).alias("p")))
    c, p = F.col("c"), F.col("p")
    pay_first = p.isNotNull() & ((p.t < c.t) | ((p.t == c.t) & (p.i < c.i)))
    ok = p.isNotNull() & (p.t <= c.t + ORDER_LIMIT_S * US)
    out = (day.where(c.isNotNull() & ~pay_first)
              .select("user_id", F.unix_millis("d.start").alias("day_ms"),
                      F.when(ok, ORDER_PAYED).otherwise(ORDER_TIMEOUT).alias("result")))
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- JN-4 on streams: left outer window join; unmatched views emitted when the hour closes ---------------
@register("stream_window_join_left", f"""
WITH v AS (SELECT user_id, event_id AS view_id, epoch_us(ts) // {3600 * US} AS b
           FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id AS click_id, epoch_us(ts) // {3600 * US} AS b
      FROM events WHERE event_type = 'click'),
j AS (SELECT v.user_id, (v.b + 1) * 3600000 AS window_end, view_id, click_id
      FROM v LEFT JOIN c ON v.user_id = c.user_id AND v.b = c.b)
SELECT * FROM j
""")
def stream_window_join_left(spark, sf):
    vs, base = events_stream(spark, sf, "wjl_v", where=F.col("event_type") == "view",
                          close={"user_id": -1})
    cs, _ = events_stream(spark, sf, "wjl_c", where=F.col("event_type") == "click",
                          close={"user_id": -2})
    v = (vs.withWatermark("ts", "0 seconds")
           .select(F.col("user_id").alias("v_user"), F.col("event_id").alias("view_id"),
                   F.window("ts", "1 hour").alias("vw")))
    c = (cs.withWatermark("ts", "0 seconds")
           .select(F.col("user_id").alias("c_user"), F.col("event_id").alias("click_id"),
                   F.window("ts", "1 hour").alias("cw")))
    j = v.join(c, (F.col("v_user") == F.col("c_user")) & (F.col("vw") == F.col("cw")), "left_outer")
    out = j.select(F.col("v_user").alias("user_id"), F.unix_millis("vw.end").alias("window_end"),
                   "view_id", "click_id")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- TOP-2 + WIN-10 on a stream: top 5 per window, refined as (late) rows update the counts ---------
@register("stream_hot_pages_refined", f"""
WITH w AS ({sliding(ev("event_type = 'click'"), 600, 5, "item_id")}),
c AS (SELECT item_id, (ws + {600 * US}) // 1000 AS window_end, count(*) AS click_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY click_count DESC, item_id)
      AS top_rank FROM c)
SELECT window_end, item_id, click_count, top_rank FROM r WHERE top_rank <= 5
""")
def stream_hot_pages_refined(spark, sf):
    from tidepool.streaming.windows import latest_top_n, refine_sliding_top_n

    sdf, base = events_stream(spark, sf, "hot_pages_refined", where=F.col("event_type") == "click", late_s=60)
    panes = (sdf.withWatermark("ts", f"{60 + 600} seconds")
                .groupBy("item_id", F.window("ts", "5 seconds").alias("w"))
                .agg(F.count(F.lit(1)).alias("click_count"), F.max(F.unix_micros("ts")).alias("last_us"))
                .select("item_id", F.unix_millis("w.start").alias("pane"), "click_count", "last_us"))
    run_foreach_batch(panes, refine_sliding_top_n(f"{base}/out", "item_id", "click_count", 600, 5, 5, 60),
                      f"{base}/ckpt", mode="update")
    return latest_top_n(_read(spark, f"{base}/out"), ["window_end"]).select(
        "window_end", "item_id", "click_count", "top_rank")


# --- PAT-4 on a stream: each create settled by the first later pay, or timed out by the watermark ------
@register("stream_order_timeout_seq", f"""
WITH s AS (SELECT user_id, epoch_ms(date_trunc('day', ts)) AS day_ms, event_id, event_type,
                  epoch_us(ts) AS t,
                  min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) OVER (
                      PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
           FROM events WHERE event_type IN ('click', 'purchase'))
SELECT user_id, day_ms, event_id AS create_event_id,
       CASE WHEN np IS NOT NULL AND np - t < {ORDER_LIMIT_S * US} THEN 'payed successfully'
            ELSE 'timeout' END AS result
FROM s WHERE event_type = 'click'
""")
def stream_order_timeout_seq(spark, sf):
    sdf, base = events_stream(spark, sf, "order_timeout",
                              where=F.col("event_type").isin("click", "purchase"), close=True)
    sdf = sdf.withColumn("day_ms", F.unix_millis(F.date_trunc("day", "ts")))
    steps = [Step("create", F.col("event_type") == "click"), Step("pay", F.col("event_type") == "purchase")]
    found = sequence_stream(sdf, ["user_id", "day_ms"], "ts", "event_id", steps, ORDER_LIMIT_S)
    result = F.when(F.col("status") == "matched", PAYED).otherwise("timeout")
    run_append(found.select("user_id", "day_ms", F.col("create.event_id").alias("create_event_id"), result.alias("result")),
               f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-2 in general on a stream: three steps, one of them strict, and timeouts ------------------------
@register("stream_browse_buy_sequence", ORACLE["browse_buy_sequence"])
def stream_browse_buy_sequence(spark, sf):
    from tidepool.plans import patterns as P

    sdf, base = events_stream(spark, sf, "browse_buy", close={"user_id": -1})
    found = sequence_stream(sdf, "user_id", "ts", "event_id", P.browse_buy_steps(), P.BUY_WITHIN_S)
    run_append(P.browse_buy(found), f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- JN-2 on streams: full outer interval join; unmatched rows leave when their band has closed ---------
@register("stream_reconcile", f"""
WITH p AS (SELECT user_id, event_id AS purchase_id, epoch_us(ts) AS pt FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, event_id AS click_id, epoch_us(ts) AS ct FROM events WHERE event_type = 'click'),
m AS (SELECT p.user_id, purchase_id, click_id FROM p JOIN c ON p.user_id = c.user_id
      AND c.ct BETWEEN p.pt - {BAND_S * US} AND p.pt + {BAND_S * US})
SELECT 'matched' AS tag, user_id, purchase_id, click_id FROM m
UNION ALL
SELECT 'unmatched_left', user_id, purchase_id, NULL FROM p
WHERE purchase_id NOT IN (SELECT purchase_id FROM m)
UNION ALL
SELECT 'unmatched_right', user_id, NULL, click_id FROM c
WHERE click_id NOT IN (SELECT click_id FROM m)
""")
def stream_reconcile(spark, sf):
    ps, base = events_stream(spark, sf, "rec_p", where=F.col("event_type") == "purchase",
                          close={"user_id": -1})
    cs, _ = events_stream(spark, sf, "rec_c", where=F.col("event_type") == "click",
                          close={"user_id": -2})
    p = ps.select(F.col("user_id").alias("p_user"), F.col("event_id").alias("purchase_id"),
                  F.col("ts").alias("pts")).withWatermark("pts", "0 seconds")
    c = cs.select(F.col("user_id").alias("c_user"), F.col("event_id").alias("click_id"),
                  F.col("ts").alias("cts")).withWatermark("cts", "0 seconds")
    cond = ((F.col("p_user") == F.col("c_user"))
            & (F.col("cts") >= F.col("pts") - F.expr(f"INTERVAL {BAND_S} SECONDS"))
            & (F.col("cts") <= F.col("pts") + F.expr(f"INTERVAL {BAND_S} SECONDS")))
    j = p.join(c, cond, "full_outer")
    tag = (F.when(F.col("purchase_id").isNotNull() & F.col("click_id").isNotNull(), "matched")
            .when(F.col("purchase_id").isNotNull(), "unmatched_left").otherwise("unmatched_right"))
    out = j.select(tag.alias("tag"), F.coalesce("p_user", "c_user").alias("user_id"),
                   "purchase_id", "click_id")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- PAT-3 on a stream: N fails in a row within a bound ------------------------------------------------
@register("stream_n_failures", f"""
WITH s AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t,
                  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
                      OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS nf,
                  lag(epoch_us(ts), 2) OVER ({_W}) AS t0,
                  lag(event_id, 2) OVER ({_W}) AS id0
           FROM events)
SELECT user_id, id0 AS first_event_id, event_id AS last_event_id, t0 // 1000 AS first_fail_ms,
       t // 1000 AS last_fail_ms
FROM s WHERE nf = 3 AND t0 IS NOT NULL AND t - t0 < {48 * 3600 * US}
""")
def stream_n_failures(spark, sf):
    return _fails(spark, sf, "n_failures", 3, 48 * 3600)


# --- AGG-7 on a stream: running sum per event --------------------------------------------------------------
@register("stream_rolling_sum", f"""
SELECT user_id, event_id,
       CAST(sum(CAST(value AS DECIMAL(12, 2))) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
       AS running_sum
FROM events
""")
def stream_rolling_sum(spark, sf):
    return _ordered(spark, sf, "rolling_sum", RunningSumProcessor(),
                    "user_id long, event_id long, running_sum double")


# --- WIN-8 on a stream: running count per element inside each (user, sliding window) ---------------------
@register("stream_window_running_count", f"""
WITH w AS ({sliding(ev(), 86400, 21600, "event_id, user_id, t")})
SELECT event_id, user_id, ws // 1000 AS window_start, (ws + {86400 * US}) // 1000 AS window_end,
       row_number() OVER (PARTITION BY user_id, ws ORDER BY t, event_id) AS running_count
FROM w
""")
def stream_window_running_count(spark, sf):
    out = _ordered(spark, sf, "window_running_count", WindowRunningCountProcessor(86400, 21600),
                   "user_id long, window_start long, event_id long, window_end long, running_count long")
    return out.select("event_id", "user_id", "window_start", "window_end", "running_count")


# --- TOP-3 on a stream: composite key item-user, top 3 per window ------------------------------------------
@register("stream_hot_items_composite", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 3600, 300,
                    "CAST(item_id AS VARCHAR) || '-' || CAST(user_id AS VARCHAR) AS item_user")}),
c AS (SELECT item_user, (ws + {3600 * US}) // 1000 AS window_end, count(*) AS view_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_user)
      AS top_rank FROM c)
SELECT window_end, item_user, view_count, top_rank FROM r
WHERE top_rank <= 3
""")
def stream_hot_items_composite(spark, sf):
    sdf, base = events_stream(spark, sf, "hot_items_composite", where=F.col("event_type") == "view", close=True)
    sdf = sdf.withColumn("item_user", F.concat_ws("-", "item_id", "user_id"))
    counts = stream_window_agg(sdf, "ts", 3600, 300, ["item_user"],
                               {"view_count": ("count", None)}, panes=True)
    run_foreach_batch(counts, rank_batches(f"{base}/out", ["window_end"], "view_count",
                                           ["item_user"], 3), f"{base}/ckpt")
    return _read(spark, f"{base}/out").select("window_end", "item_user", "view_count", "top_rank")


# --- AGG-10 on a stream: per-day counts with a never-reset cumulative total -------------------------------
@register("stream_cumulative_window_count", f"""
WITH d AS (SELECT user_id, (epoch_us(ts) // {86400 * US} + 1) * 86400000 AS window_end, count(*) AS cnt
           FROM events GROUP BY ALL),
c AS (SELECT user_id, window_end, cnt,
             CAST(sum(cnt) OVER (PARTITION BY user_id ORDER BY window_end ROWS UNBOUNDED PRECEDING) AS BIGINT)
                 AS cumulative,
             lead(window_end) OVER (PARTITION BY user_id ORDER BY window_end) AS next_end
      FROM d)
SELECT user_id, window_end, cnt, cumulative FROM c
""")
def stream_cumulative_window_count(spark, sf):
    return _ordered(spark, sf, "cumulative", CumulativeWindowProcessor(86400),
                    "user_id long, window_end long, cnt long, cumulative long", close=True)


# --- TOP-4 on a stream: the top-3 ranking of each closed window rendered as one text block -------------
@register("stream_hot_items_report", f"""
WITH w AS ({sliding(ev("event_type = 'view'"), 3600, 300, "item_id")}),
c AS (SELECT item_id, (ws + {3600 * US}) // 1000 AS window_end, count(*) AS view_count
      FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id)
      AS top_rank FROM c)
SELECT window_end, string_agg(printf('No%d: id=%d count=%d', top_rank, item_id, view_count),
                              chr(10) ORDER BY top_rank) AS report
FROM r WHERE top_rank <= 3 GROUP BY window_end
""")
def stream_hot_items_report(spark, sf):
    from tidepool.operators.ranking import render_ranking, top_n

    sdf, base = events_stream(spark, sf, "hot_items_report", where=F.col("event_type") == "view", close=True)
    counts = stream_window_agg(sdf, "ts", 3600, 300, ["item_id"], {"view_count": ("count", None)},
                               panes=True)

    def render(batch, batch_id):
        ranked = top_n(batch, ["window_end"], "view_count", ["item_id"], 3, rank_col="top_rank")
        (render_ranking(ranked, "window_end", "item_id", "view_count", rank_col="top_rank")
         .write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}"))

    run_foreach_batch(counts, render, f"{base}/ckpt")
    return _read(spark, f"{base}/out").select("window_end", "report")


# --- WM-2/3/4: the same answers from out-of-order input, with a delay that covers the disorder ----------
LATE_S = {"pv": 3600, "login": 3 * 3600, "sum": 5 * 3600}


def _same_as(name):
    from tidepool.plans.registry import ORACLE

    return ORACLE[name]


@register("stream_pv_hourly_late", _same_as("stream_pv_hourly"))
def stream_pv_hourly_late(spark, sf):
    sdf, base = events_stream(spark, sf, "pv_late", where=F.col("event_type") == "view", close=True, late_s=LATE_S["pv"])
    out = stream_window_agg(sdf, "ts", 3600, None, [], {"pv": ("count", None)}, delay_s=LATE_S["pv"])
    run_append(out.select("window_end", "pv"), f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


@register("stream_login_fail_late", _same_as("stream_login_fail"))
def stream_login_fail_late(spark, sf):
    return _fails(spark, sf, "login_fail_late", 2, FAIL_WITHIN_S, LATE_S["login"])


@register("stream_rolling_sum_late", _same_as("stream_rolling_sum"))
def stream_rolling_sum_late(spark, sf):
    sdf, base = events_stream(spark, sf, "rolling_sum_late", close={"user_id": -1}, late_s=LATE_S["sum"])
    out = run_ordered(sdf, "user_id", "ts", "event_id", ["value"], RunningSumProcessor(),
                      "user_id long, event_id long, running_sum double", delay_s=LATE_S["sum"])
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return _read(spark, f"{base}/out")


# --- WIN-9: early results: every batch refreshes the open windows it touched; the last one is final -------
@register("stream_pv_early", _same_as("stream_pv_hourly"))
def stream_pv_early(spark, sf):
    sdf, base = events_stream(spark, sf, "pv_early", where=F.col("event_type") == "view")
    counts = (sdf.withWatermark("ts", "0 seconds").groupBy(F.window("ts", "1 hour").alias("w"))
                 .agg(F.count(F.lit(1)).alias("pv")).select(F.unix_millis("w.end").alias("window_end"), "pv"))
    return _final_updates(spark, counts, base, ["window_end"], "pv")


# --- WIN-9: every early version: batches are days, a window of two days is refreshed by each of them ------
@register("stream_pv_early_versions", f"""
WITH v AS (SELECT epoch_us(ts) // {86400 * US} AS day, epoch_us(ts) // {2 * 86400 * US} AS w FROM events WHERE event_type = 'view'),
c AS (SELECT day, w, count(*) AS n FROM v GROUP BY day, w)
SELECT day, (w + 1) * {2 * 86400 * 1000} AS window_end, CAST(sum(n) OVER (PARTITION BY w ORDER BY day) AS BIGINT) AS pv FROM c
""")
def stream_pv_early_versions(spark, sf):
    from tidepool.sources.tables import load_events

    day = F.floor(F.unix_seconds("ts") / 86400)
    sdf, base = events_stream(spark, sf, "pv_versions", where=F.col("event_type") == "view", slice_by=day)
    counts = (sdf.withWatermark("ts", "0 seconds").groupBy(F.window("ts", "2 days").alias("w"))
                 .agg(F.count(F.lit(1)).alias("pv")).select(F.unix_millis("w.end").alias("window_end"), "pv"))
    run_foreach_batch(counts, version_batches(f"{base}/out"), f"{base}/ckpt", mode="update")
    # the k-th batch is the k-th day that has views
    days = load_events(spark, sf).where(F.col("event_type") == "view").select(day.alias("day")).distinct()
    days = days.withColumn("batch_id", (F.row_number().over(Window.orderBy("day")) - 1).cast("int"))
    return _read(spark, f"{base}/out").join(days, "batch_id").select("day", "window_end", "pv")


# --- PAT-2 on a stream: its own bound -----------------------------------------------------------------
@register("stream_login_fail_seq", _same_as("login_fail_seq"))
def stream_login_fail_seq(spark, sf):
    from tidepool.plans import patterns as P

    return _fails(spark, sf, "login_fail_seq", 2, P.SEQ_WITHIN_S).withColumn("msg", F.lit(P.MSG_LOGIN_SEQ))
