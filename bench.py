"""Benchmark: run every registered query on $BENCH_SF_DIR and print one JSON line.

Each query is fully computed with a ``noop`` write (no collect to Python).
Extra entries time the three sliding-window methods (deltas, panes, direct).
``value`` is the total of the batch queries; the streaming twins (file replay
with availableNow, dominated by per-micro-batch overhead at this size) are
timed separately under ``stream_queries`` (BENCH_STREAMS=0 skips them).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidepool.operators.windows import sliding_count  # noqa: E402
from tidepool.plans.catalog import QUERIES  # noqa: E402
from tidepool.session import build_session  # noqa: E402
from tidepool.sources.tables import load_events  # noqa: E402


def _run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    names = only or sorted(n for n in QUERIES if not n.startswith("stream_"))
    _run(QUERIES["hot_items"](spark, sf_dir))  # JVM / codegen warm-up
    times: dict[str, float] = {}
    for n in names:
        times[n] = round(_run(QUERIES[n](spark, sf_dir)), 3)
    stream_times: dict[str, float] = {}
    if not only and os.environ.get("BENCH_STREAMS", "1") != "0":
        for n in sorted(q for q in QUERIES if q.startswith("stream_")):
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            stream_times[n] = round(time.perf_counter() - t0, 3)
    if not only:
        ev = load_events(spark, sf_dir).where(F.col("event_type") != "signup")
        for method in ("deltas", "panes", "direct"):
            df = sliding_count(ev.withColumn("ch", F.col("user_id") % 4), "ts",
                               ["ch", "event_type"], 3600, 10, method=method)
            times[f"channel_counts_{method}"] = round(_run(df), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds",
                      "value": round(sum(v for k, v in times.items() if k in QUERIES), 3),
                      "unit": "sec", "queries": times, "stream_queries": stream_times,
                      "stream_total": round(sum(stream_times.values()), 3),
                      "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
