"""Delivery: sinks with commits, exactly-once by headers, dropped and read rows counted,
line sources, routed outputs (SNK-1..7, SRC-1, WM-4, AGG-11, PAT-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions.timecols import next_midnight, render_ms
from tidepool.operators.aggregates import word_count
from tidepool.operators.patterns import cap_per_key
from tidepool.plans.basics import document_json
from tidepool.plans.patterns import MSG_CLICK_CAP, ORDER
from tidepool.plans.registry import ORACLE, register
from tidepool.plans.sqlfrag import US
from tidepool.sinks.datasource import FileTarget, target_format
from tidepool.sinks.writers import document_records, print_sink, route_write
from tidepool.sources.kafka import drop_replayed, kafka_records, with_record_headers
from tidepool.sources.parse import parse_delimited, split_valid
from tidepool.sources.tables import load_events, load_table
from tidepool.sources.text import read_lines
from tidepool.streaming.runner import (events_stream, observed, read_staged, rows_dropped, run_append,
                                       run_foreach_batch, scratch, stage_files)
from tidepool.streaming.stateful import flat_map_with_state

DAY_S = 86400


# --- SNK-5 / UDF-11: documents to a target that commits whole batches ----------------------------
@register("stream_document_sink", ORACLE["document_json"])
def stream_document_sink(spark, sf):
    sdf, base = events_stream(spark, sf, "document_sink")
    docs = document_records(sdf, "sensor", {"id": F.col("user_id"), "ts": F.unix_seconds("ts"),
                                            "temperature": F.col("value").cast("decimal(12,2)")}, ["event_id"])
    target = FileTarget(f"{base}/documents")
    fmt = target_format(spark, "tidepool_documents", target)
    q = docs.writeStream.format(fmt).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    return target.read(spark, "index string, doc_id string, doc string")


@register("batch_document_sink", ORACLE["document_json"])
def batch_document_sink(spark, sf):
    target = FileTarget(f"{scratch(spark, 'batch_documents')}/documents")
    fmt = target_format(spark, "tidepool_batch_documents", target)
    docs = document_json(spark, sf)
    for _ in range(2):  # a job that runs again under the same batch name adds nothing
        docs.write.format(fmt).option("batch", "all").mode("append").save()
    return target.read(spark, "index string, doc_id string, doc string")


# --- SNK-2 / SNK-3: records with (batch_id, row_id) headers; batches are replayed; the reader drops the copies ---
@register("stream_exactly_once", """
SELECT CAST(event_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) || ':' || event_type AS value FROM events
""")
def stream_exactly_once(spark, sf):
    sdf, base = events_stream(spark, sf, "exactly_once")
    said = sdf.withColumn("text", F.concat_ws(":", "user_id", "event_type"))

    def send(batch, batch_id):
        records = kafka_records(batch.select("event_id", "text", "ts"), "text", "event_id", extra=["ts"])
        marked = with_record_headers(records, batch_id, ["key"])
        marked.write.mode("append").parquet(f"{base}/topic")
        if batch_id % 2 == 0:  # at least once: the batch had been written when its task was lost, and comes again
            marked.repartition(3).write.mode("append").parquet(f"{base}/topic")

    run_foreach_batch(said, send, f"{base}/ckpt")
    topic = spark.read.parquet(f"{base}/topic")
    arrived = read_staged(spark, f"{base}/topic", topic.schema, 1000)
    run_append(drop_replayed(arrived, "ts", 3600).select("key", "value"), f"{base}/out", f"{base}/read")
    return spark.read.parquet(f"{base}/out")


# --- WM-4 + AGG-11: rows beyond the delay are dropped and counted, rows read are observed ----------------------
# Batches are days of arrival; an event arrives up to three days late (a rule of its id), the
# watermark waits one. A batch drops what the watermark of the batch before had passed.
LATEST_S, WAIT_S = 3 * DAY_S, DAY_S
_LATE_US = f"event_id * 7919 % {LATEST_S} * {US}"


@register("stream_late_dropped", f"""
WITH v AS (SELECT event_id, epoch_us(ts) AS t, (epoch_us(ts) + {_LATE_US}) // {DAY_S * US} AS day
           FROM events WHERE event_type = 'view'),
b AS (SELECT day, max(t) // 1000 AS last FROM v GROUP BY day),
w AS (SELECT day, (max(last) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - {WAIT_S * 1000}) * 1000 AS mark FROM b),
k AS (SELECT v.*, coalesce(t <= mark, FALSE) AS late FROM v JOIN w USING (day))
SELECT (t // {DAY_S * US} + 1) * {DAY_S * 1000} AS window_end, count(*) AS pv, (SELECT count(*) FROM k) AS rows_read,
       (SELECT count(*) FROM k WHERE late) AS rows_dropped
FROM k WHERE NOT late GROUP BY ALL
""")
def stream_late_dropped(spark, sf):
    base = scratch(spark, "late_dropped")
    views = load_events(spark, sf).where(F.col("event_type") == "view").select("event_id", "ts")
    arrival = F.unix_micros("ts") + F.col("event_id") * 7919 % LATEST_S * US
    n_files = stage_files(views, f"{base}/input", "ts", arrival=arrival, slice_by=F.floor(arrival / (DAY_S * US)))
    sdf = read_staged(spark, f"{base}/input", views.schema, n_files).observe("read", F.count(F.lit(1)).alias("rows"))
    kept = sdf.withWatermark("ts", f"{WAIT_S} seconds").dropDuplicates(["event_id", "ts"])
    progress = run_append(kept, f"{base}/out", f"{base}/ckpt")
    end = (F.floor(F.unix_micros("ts") / (DAY_S * US)) + 1) * (DAY_S * 1000)
    pv = spark.read.parquet(f"{base}/out").groupBy(end.cast("bigint").alias("window_end")).agg(F.count(F.lit(1)).alias("pv"))
    return pv.select("*", F.lit(observed(progress, "read", "rows")).cast("bigint").alias("rows_read"),
                     F.lit(rows_dropped(progress)).cast("bigint").alias("rows_dropped"))


# --- SRC-1 + SNK-1: labelled lines to text files, read back as lines --------------------------------------------
@register("printed_lines", """
SELECT 'event> {"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"}' AS value FROM events
""")
def printed_lines(spark, sf):
    path = f"{scratch(spark, 'printed')}/lines"
    print_sink(load_events(spark, sf).select("event_id", "event_type"), "event", path)
    return read_lines(spark, path)


# --- PRJ-1 with its quarantine: good rows and rejected lines --------------------------------------------------------
@register("parse_quarantine", """
SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN event_id % 7 = 0 THEN CAST(event_id AS VARCHAR) || ',x' || CAST(user_id AS VARCHAR) END AS rejected
FROM events
""")
def parse_quarantine(spark, sf):
    user = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), "user_id")).otherwise(F.col("user_id").cast("string"))
    lines = load_events(spark, sf).select(F.concat_ws(",", "event_id", user).alias("value"))
    good, bad = split_valid(parse_delimited(lines, "event_id bigint, user_id bigint"))
    return (good.select("event_id", F.lit(None).cast("string").alias("rejected"))
            .unionByName(bad.select(F.lit(None).cast("bigint").alias("event_id"), F.col("value").alias("rejected"))))


# --- PRJ-6, white space without a filter: empty words as the JVM's split leaves them ------------------------------------
@register("word_count_unfiltered", """
WITH d AS (SELECT text, regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+$', '') AS cut FROM documents),
w AS (SELECT unnest(regexp_split_to_array(cut, '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM d WHERE cut <> '' OR text = '')
SELECT word, count(*) AS cnt FROM w GROUP BY word
""")
def word_count_unfiltered(spark, sf):
    return word_count(load_table(spark, sf, "documents").select("text"), "text", drop_empty=False)


# --- FN-7 + FN-8: times as text with their fraction, and the next midnight ---------------------------------------------
@register("rendered_times", """
WITH m AS (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms, rtrim(lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0'), '0') AS part FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || CASE WHEN part = '' THEN '0' ELSE part END AS text,
       epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY) AS midnight_ms
FROM m
""")
def rendered_times(spark, sf):
    ev = load_events(spark, sf).select("event_id", "ts")
    return ev.select("event_id", render_ms(F.unix_millis("ts")).alias("text"), F.unix_millis(next_midnight("ts")).alias("midnight_ms"))


# --- SNK-7: tagged sub-outputs, each to its own place -----------------------------------------------------------------
@register("routed_outputs", """
SELECT event_type AS place, event_id, user_id FROM events WHERE event_type IN ('view', 'click')
""")
def routed_outputs(spark, sf):
    base = scratch(spark, "routed")
    rows = load_events(spark, sf).select(F.col("event_type").alias("tag"), "event_id", "user_id")
    places = ("view", "click")
    route_write(rows, "tag", {p: lambda df, p=p: df.write.mode("overwrite").parquet(f"{base}/{p}") for p in places})
    parts = [spark.read.parquet(f"{base}/{p}").withColumn("place", F.lit(p)) for p in places]
    return parts[0].unionByName(parts[1])


# --- PAT-7 per user and day, where the cap bites: passed and blocked clicks ---------------------------------------------
DAY_CAP = 1
_DAY_CAP_SQL = f"""
WITH r AS (SELECT user_id, event_id, epoch_ms(date_trunc('day', ts)) AS day_ms,
                  row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS click_no
           FROM events WHERE event_type = 'click')
SELECT user_id, event_id, day_ms, click_no, CASE WHEN click_no <= {DAY_CAP} THEN 'pass' ELSE '{MSG_CLICK_CAP.format(DAY_CAP)}' END AS kind
FROM r WHERE click_no <= {DAY_CAP + 1}
"""


@register("click_cap_daily", _DAY_CAP_SQL)
def click_cap_daily(spark, sf):
    clicks = (load_events(spark, sf).where(F.col("event_type") == "click")
              .select("event_id", "user_id", "ts", F.unix_millis(F.date_trunc("day", "ts")).alias("day_ms")))
    kind = F.when(F.col("click_no") <= DAY_CAP, "pass").otherwise(MSG_CLICK_CAP.format(DAY_CAP))
    return cap_per_key(clicks, ["user_id", "day_ms"], ORDER, DAY_CAP).select("user_id", "event_id", "day_ms", "click_no", kind.alias("kind"))


@register("stream_click_cap_daily", _DAY_CAP_SQL)
def stream_click_cap_daily(spark, sf):
    """The cap as a user flat map: a counter per user that starts again every day."""
    def count(row, state):
        n = state[1] + 1 if state is not None and state[0] == row.day_ms else 1
        said = "pass" if n <= DAY_CAP else MSG_CLICK_CAP.format(DAY_CAP)
        return ([(row.id, row.day_ms, n, said)] if n <= DAY_CAP + 1 else []), (row.day_ms, n)

    sdf, base = events_stream(spark, sf, "click_cap_daily", where=F.col("event_type") == "click")
    sdf = sdf.withColumn("day_ms", F.unix_millis(F.date_trunc("day", "ts")))
    out = flat_map_with_state(sdf, "user_id", "ts", "event_id", {"day_ms": "bigint"}, count, "day_ms bigint, n bigint",
                              "event_id bigint, day_ms bigint, click_no bigint, kind string")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")
