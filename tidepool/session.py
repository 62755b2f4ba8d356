"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every tidepool job relies on. Time zone is pinned so that
# window bounds and day boundaries are UTC everywhere; AQE re-plans joins and
# coalesces partitions at run time; skew-join splitting is on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


_SCRATCH: dict[str, str] = {}  # scratch folder of each local application

# Subset of BASE_CONF that can be changed on a running session (SQL confs).
RUNTIME_CONF = {k: v for k, v in BASE_CONF.items() if k.startswith("spark.sql.")}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Apply the tidepool SQL settings to a session built elsewhere (UTC time
    zone, AQE, RocksDB state store for keyed state, ...)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidepool", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the tidepool defaults.

    On a cluster pass ``master=None`` so the launcher decides, and size
    ``shuffle_partitions`` to the data (roughly input bytes / 128 MiB);
    AQE coalesces small partitions afterwards.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, sub: str = "") -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster sets it to a shared file system. Where it is unset, a scratch
    folder is made, on a local master only: executors elsewhere could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        base = _SCRATCH[app]
    return os.path.join(base, sub) if sub else base
