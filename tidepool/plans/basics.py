"""Filters, sets, aggregates, parsers and sink shapes on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions.text import normalize_int
from tidepool.operators.aggregates import (cumulative_window_count, int_mean, payment_totals,
                                           rolling_reduce, running_count, running_sum, with_metric,
                                           word_count)
from tidepool.operators.filters import (connect_map, prefix_filter, split_by, tag_outputs,
                                        threshold_alert, union_all, with_partition)
from tidepool.operators.windows import window_agg
from tidepool.plans.registry import register
from tidepool.sinks.writers import document_records, latest_per_key, merge_upsert
from tidepool.sources.parse import parse_access_log, parse_delimited, parse_pay_result, split_valid
from tidepool.sources.tables import load_events, load_table
from tidepool.streaming.runner import scratch

ORDER = ["ts", "event_id"]
HIGH, FREEZE = 30.0, 32.0

# Labels and messages of the routing jobs.
MSG_HIGH, MSG_OK = "high temperature warning", "healthy"
MSG_FREEZE = "freezing alert for "
PART_PREFIX = "small"

_W = "PARTITION BY user_id ORDER BY ts, event_id"


def _ev(spark, sf, *cols):
    ev = load_events(spark, sf)
    return ev.select(*cols) if cols else ev


# --- FIL-5: labelled split, both labels selected ------------------------------------------
@register("split_high_low", f"""
SELECT event_id, user_id, value, CASE WHEN value > {HIGH} THEN 'high' ELSE 'low' END AS label
FROM events
""")
def split_high_low(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "value")
    return split_by(ev, {"high": F.col("value") > HIGH}, default="low")


# --- SET-2: connect two shapes, co-map into one output -------------------------------------
@register("connect_map", f"""
SELECT event_id, user_id, value, '{MSG_HIGH}' AS msg FROM events WHERE value > {HIGH}
UNION ALL
SELECT event_id, user_id, NULL, '{MSG_OK}' FROM events WHERE NOT value > {HIGH}
""")
def connect_map_q(spark, sf):
    ev = split_by(_ev(spark, sf, "event_id", "user_id", "value"),
                  {"high": F.col("value") > HIGH}, default="low")
    high, low = ev.where(F.col("label") == "high"), ev.where(F.col("label") == "low")
    return connect_map(high, lambda d: d.select("event_id", "user_id", "value",
                                                F.lit(MSG_HIGH).alias("msg")),
                       low, lambda d: d.select("event_id", "user_id", F.lit(MSG_OK).alias("msg")))


# --- SET-1: union all ----------------------------------------------------------------------
@register("union_all", """
SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, user_id, event_type FROM events WHERE event_type = 'view'
""")
def union_all_q(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "event_type")
    return union_all(ev.where(F.col("event_type") == "click"), ev.where(F.col("event_type") == "view"))


# --- FIL-6: threshold alert to a side output; all rows stay in main ----------------------------
@register("threshold_alert", f"""
SELECT event_id, user_id, 'main' AS output, NULL AS msg FROM events
UNION ALL
SELECT event_id, user_id, 'side', '{MSG_FREEZE}' || CAST(user_id AS VARCHAR) FROM events
WHERE value < {FREEZE}
""")
def threshold_alert_q(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "value")
    main, side = threshold_alert(ev, F.col("value") < FREEZE,
                                 F.concat(F.lit(MSG_FREEZE), F.col("user_id").cast("string")))
    return tag_outputs(main.drop("value"), side.drop("value")).select(
        "event_id", "user_id", "output", "msg")


# --- FIL-4: prefix filter ---------------------------------------------------------------------
@register("prefix_filter", f"""
SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, '{PART_PREFIX}')
""")
def prefix_filter_q(spark, sf):
    return prefix_filter(load_table(spark, sf, "part").select("p_partkey", "p_name"), "p_name",
                         PART_PREFIX)


# --- AGG-1 + PRJ-6: word counts over whole documents -------------------------------------------
@register("word_count", """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM documents)
WHERE length(word) > 0 GROUP BY word
""")
def word_count_q(spark, sf):
    return word_count(load_table(spark, sf, "documents").select("text"))


@register("word_count_raw", """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
  WHERE rtrim(text, ' ') <> '')
GROUP BY word
""")
def word_count_raw(spark, sf):
    return word_count(load_table(spark, sf, "documents").select("text"), jvm_split=True)


# --- AGG-2: running count per event ------------------------------------------------------------
@register("running_count", f"""
SELECT event_id, user_id, count(*) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS running_count
FROM events
""")
def running_count_q(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "ts")
    return running_count(ev, "user_id", ORDER, "ts").select("event_id", "user_id", "running_count")


# --- AGG-7: rolling sum (exact decimal accumulation) -------------------------------------------
@register("rolling_sum", f"""
SELECT event_id, user_id,
       CAST(sum(CAST(value AS DECIMAL(12, 2))) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
       AS running_sum
FROM events
""")
def rolling_sum(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "ts", "value")
    r = running_sum(ev, "user_id", ORDER, "ts", F.col("value").cast("decimal(12,2)"))
    return r.select("event_id", "user_id", F.col("running_sum").cast("double").alias("running_sum"))


# --- AGG-6: rolling reduce ----------------------------------------------------------------------
@register("rolling_reduce", f"""
SELECT event_id, user_id,
       first_value(CAST(floor(epoch(ts)) AS BIGINT)) OVER ({_W}) + row_number() OVER ({_W}) - 1 AS reduced_ts_s,
       CASE WHEN row_number() OVER ({_W}) = 1 THEN value ELSE value + 10 END AS reduced_value
FROM events
""")
def rolling_reduce_q(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "ts", "value")
    r = rolling_reduce(ev, "user_id", ORDER, "ts", "value")
    return r.select("event_id", "user_id", "reduced_ts_s", "reduced_value")


# --- AGG-5: integer-division mean of event time, per type and UTC day ---------------------------
@register("int_mean", """
SELECT event_type, epoch_ms(date_trunc('day', ts)) AS day_ms,
       CAST(sum(CAST(floor(epoch(ts)) AS BIGINT)) // count(*) AS DOUBLE) AS mean_ts_s
FROM events GROUP BY ALL
""")
def int_mean_q(spark, sf):
    ev = _ev(spark, sf, "event_type", "ts")
    return (ev.groupBy("event_type", F.unix_millis(F.date_trunc("day", "ts")).alias("day_ms"))
              .agg(int_mean(F.unix_seconds("ts")).alias("mean_ts_s")))


# --- AGG-10: cumulative count across daily windows -----------------------------------------------
@register("cumulative_window_count", f"""
SELECT user_id, window_end, cnt,
       CAST(sum(cnt) OVER (PARTITION BY user_id ORDER BY window_end ROWS UNBOUNDED PRECEDING) AS BIGINT)
           AS cumulative
FROM (SELECT user_id, (epoch_us(ts) // {86400 * 10**6} + 1) * 86400000 AS window_end,
             count(*) AS cnt FROM events GROUP BY ALL)
""")
def cumulative_window_count_q(spark, sf):
    w = window_agg(_ev(spark, sf, "user_id", "ts"), "ts", 86400, keys=["user_id"])
    return cumulative_window_count(w, "user_id", "window_end", "cnt").select(
        "user_id", "window_end", "cnt", F.col("cumulative").cast("bigint").alias("cumulative"))


# --- AGG-11: counted input (observed metric) feeding a per-type count -----------------------------
@register("counted_types", """
SELECT event_type, count(*) AS cnt, (SELECT count(*) FROM events) AS rows_read FROM events GROUP BY ALL
""")
def counted_types(spark, sf):
    ev, obs = with_metric(_ev(spark, sf, "event_type"), "events_read")
    counts = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    path = f"{scratch(spark, 'counted_types')}/out"
    counts.write.mode("overwrite").parquet(path)  # the one run; the metric is known after it
    return spark.read.parquet(path).withColumn("rows_read", F.lit(obs.get["rows"]).cast("bigint"))


# --- PRJ-1: comma records with stray spaces -> typed columns -------------------------------------
@register("parse_delimited", """
SELECT event_id, user_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s FROM events
""")
def parse_delimited_q(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "event_type", "value", "ts")
    lines = ev.select(F.concat_ws(",", "event_id", F.concat(F.lit(" "), "user_id", F.lit(" ")),
                                  "event_type", F.concat(F.lit("  "), "value"),
                                  F.unix_seconds("ts")).alias("value"))
    good, _bad = split_valid(parse_delimited(
        lines, "event_id bigint, user_id bigint, event_type string, value double, ts_s bigint"))
    return good


# --- PRJ-2: tab records, no trimming ------------------------------------------------------------
@register("parse_tab_log", """
SELECT CAST(epoch_ms(date_trunc('day', ts)) AS VARCHAR) AS dt, event_type AS logkey,
       CAST(user_id AS VARCHAR) AS userid, epoch_us(ts) // 1000 AS time, CAST(event_id AS VARCHAR) AS logid
FROM events
""")
def parse_tab_log(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "event_type", "ts")
    lines = ev.select(F.concat_ws("\t", F.unix_millis(F.date_trunc("day", "ts")), "event_type",
                                  "user_id", F.unix_millis("ts"), "event_id").alias("value"))
    p = parse_delimited(lines, "dt string, logkey string, userid string, time bigint, logid string",
                        sep="\t", trim=False)
    good, _ = split_valid(p)
    return good


# --- PRJ-3: access log lines -> ip, user, time, method, url ---------------------------------------
def _access_lines(ev):
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), F.col("user_id") % 256, F.col("item_id"))
    method = F.when(F.col("event_type") == "view", "GET").otherwise("POST")
    url = F.concat(F.lit("/item/"), F.col("item_id"))
    return ev.select(F.concat_ws(" ", ip, "user_id", F.lit("-"),
                                 F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
                                 method, url).alias("value"))


@register("access_log_parse", """
SELECT '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || json_extract_string(props, '$.k') AS ip,
       CAST(user_id AS VARCHAR) AS user_id,
       epoch_ms(date_trunc('second', ts)) AS event_ms,
       CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
       '/item/' || json_extract_string(props, '$.k') AS url
FROM events
""")
def access_log_parse(spark, sf):
    p = parse_access_log(_access_lines(_ev(spark, sf)))
    return p.select("ip", "user_id", F.unix_millis("event_time").alias("event_ms"), "method", "url")


# --- PRJ-8: integer token normalisation -----------------------------------------------------------
@register("normalize_int", """
SELECT event_id, lpad(json_extract_string(props, '$.k'), 4, '0') AS token,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS normalized
FROM events
""")
def normalize_int_q(spark, sf):
    ev = _ev(spark, sf).select("event_id", F.lpad(F.col("item_id").cast("string"), 4, "0").alias("token"))
    return ev.withColumn("normalized", normalize_int("token", lenient=False))


# --- PRJ-4: JSON payment results (missing provinceCode -> 0) ---------------------------------------
def _pay_lines(ev):
    obj = F.struct(F.lit("recharge").alias("serviceName"),
                   F.when(F.col("event_type") == "purchase", "0000").otherwise("0001").alias("bussinessRst"),
                   F.col("value").alias("chargefee"),
                   F.col("event_id").cast("string").alias("requestId"),
                   F.date_format("ts", "yyyyMMddHHmmssSSS").alias("receiveNotifyTime"),
                   F.when(F.col("event_type") != "signup", F.col("user_id") % 31).alias("provinceCode"))
    return ev.select(F.to_json(obj).alias("value"))


_PAY_SQL = """
SELECT 'recharge' AS serviceName,
       CASE WHEN event_type = 'purchase' THEN '0000' ELSE '0001' END AS bussinessRst,
       value AS chargefee, CAST(event_id AS VARCHAR) AS requestId,
       strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST((epoch_us(ts) // 1000 % 1000) AS VARCHAR), 3, '0')
           AS receiveNotifyTime,
       CASE WHEN event_type <> 'signup' THEN CAST(user_id % 31 AS INTEGER) ELSE 0 END AS provinceCode
FROM events
"""


@register("pay_result_parse", _PAY_SQL)
def pay_result_parse(spark, sf):
    return parse_pay_result(_pay_lines(_ev(spark, sf))).drop("id")


# --- AGG-3: running payment totals over parsed results --------------------------------------------
@register("payment_totals", f"""
WITH p AS ({_PAY_SQL})
SELECT count(*) AS all_orders, count(*) FILTER (WHERE bussinessRst = '0000') AS success_orders,
       CAST(sum(CAST(chargefee AS DECIMAL(12, 2))) FILTER (WHERE bussinessRst = '0000') AS DOUBLE)
           AS success_money,
       arg_max(receiveNotifyTime, (receiveNotifyTime, requestId))
           FILTER (WHERE bussinessRst = '0000') AS last_success_time
FROM p
""")
def payment_totals_q(spark, sf):
    p = parse_pay_result(_pay_lines(_ev(spark, sf)))
    ok = F.col("bussinessRst") == "0000"
    return payment_totals(p, ok, F.col("chargefee"),
                          F.struct("receiveNotifyTime", "requestId"), "receiveNotifyTime")


# --- PRJ-9: executing partition per row (layout dependent -> rows-only) ----------------------------
@register("with_partition", """
SELECT event_id, user_id, TRUE AS has_partition FROM events
""")
def with_partition_q(spark, sf):
    # which partition a row is in depends on the layout; that it names one does not
    p = with_partition(_ev(spark, sf, "event_id", "user_id"))
    return p.select("event_id", "user_id", (F.col("partition") >= 0).alias("has_partition"))


# --- SNK-4: hash upsert, last value per field wins --------------------------------------------------
@register("hash_upsert_view", f"""
SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL
""")
def hash_upsert_view(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "ts", "value")
    return latest_per_key(ev, ["user_id"], ["value"], F.struct("ts", "event_id"))


# --- SNK-6: relational upsert of the latest purchase into customer balances -----------------------------
@register("upsert_merge", """
WITH u AS (SELECT user_id AS c_custkey, arg_max(value, (ts, event_id)) AS v
           FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.v ELSE c.c_acctbal END AS c_acctbal,
       CASE WHEN u.c_custkey IS NOT NULL AND c.c_custkey IS NOT NULL THEN 'update'
            WHEN u.c_custkey IS NOT NULL THEN 'insert' ELSE 'keep' END AS op
FROM customer c FULL OUTER JOIN u ON c.c_custkey = u.c_custkey
""")
def upsert_merge(spark, sf):
    target = load_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    purchases = _ev(spark, sf).where(F.col("event_type") == "purchase")
    upd = latest_per_key(purchases.withColumnRenamed("user_id", "c_custkey")
                         .withColumnRenamed("value", "c_acctbal"),
                         ["c_custkey"], ["c_acctbal"], F.struct("ts", "event_id"))
    return merge_upsert(target, upd, "c_custkey", ["c_acctbal"])


# --- SNK-5: documents with string fields and a deterministic id ------------------------------------------
@register("document_json", """
SELECT 'sensor' AS index, sha256(CAST(event_id AS VARCHAR)) AS doc_id,
       '{"id":"' || CAST(user_id AS VARCHAR) || '","ts":"' || CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
       || '","temperature":"' || CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) || '"}' AS doc
FROM events
""")
def document_json(spark, sf):
    ev = _ev(spark, sf, "event_id", "user_id", "ts", "value")
    return document_records(ev, "sensor", {"id": F.col("user_id"), "ts": F.unix_seconds("ts"),
                                           "temperature": F.col("value").cast("decimal(12,2)")},
                            ["event_id"])
