"""Run a streaming query to completion and read its output back as a batch.

Everything lives under the shared folder named by ``spark.checkpoint.dir``
(set by the cluster; tests set a scratch one): the staged input files, the
query checkpoint and the output table. A restarted query on the same
checkpoint continues exactly where it stopped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir


# Rows of one staged file and of one micro-batch; both only set parallelism and
# batch size, never the result.
ROWS_PER_FILE = 500_000
ROWS_PER_BATCH = 50_000_000
MIN_BATCHES = 4
END_AFTER = "INTERVAL 3650 DAYS"
STATE_PARTITIONS_PER_CORE = 2


def scratch(spark: SparkSession, name: str) -> str:
    """Folder of one run of a stream. ``spark.tidepool.stream.run`` names the
    run: a job that sets it continues an interrupted run of the same name."""
    run = spark.conf.get("spark.tidepool.stream.run", None) or uuid.uuid4().hex[:10]
    return checkpoint_dir(spark, f"tidepool-stream/{name}-{run}")


def stage_files(df: DataFrame, path: str, ts: str, close: bool | dict = False,
                arrival: Column | None = None, slice_by: Column | None = None) -> int:
    """Write ``df`` as slices of time that a file stream replays in order of
    ``arrival`` (epoch µs; default: the event time). Returns the number of files
    of a slice, which is the stream's batch size.

    The input is range-partitioned by arrival (Spark samples the order column for
    the bounds) and written once; a task's place in that order names its slice.
    The files are then given ascending modification times, the order in which a
    file stream reads them, and the folder gets its name only when it is
    complete: a second call with the same ``path`` finds it and writes nothing,
    so a resumed run replays the same files. Rows without a time come first.
    ``slice_by`` (a whole number that grows with time) names the slices instead:
    one file and one micro-batch each.

    ``close`` appends the end of the input: one row of NULLs far later than all
    others. It moves the watermark past every open window and deadline, and
    its own window never closes, so it is never part of a result. A dict gives
    values for some columns: a join needs a key (filters on null keys are moved
    below the watermark), one that no other row has.
    """
    spark = df.sparkSession
    fs, at = _file_system(spark, path)
    manifest = at.suffix("/_files_per_slice")
    if fs.exists(manifest):
        return int(spark.read.text(manifest.toString()).first().value)
    t = F.unix_micros(F.col(ts)) if arrival is None else arrival
    n, last = df.agg(F.count(F.lit(1)), F.max(ts)).first()
    n_slices = max(MIN_BATCHES, -(-n // ROWS_PER_BATCH))
    n_files = max(1, -(-n // (n_slices * ROWS_PER_FILE)))
    partial = f"{path}-{uuid.uuid4().hex[:8]}.partial"
    if slice_by is None:
        dealt = df.withColumn("__arrival", t).repartitionByRange(n_slices * n_files, F.col("__arrival").asc_nulls_first())
        placed = dealt.withColumn("__slice", F.floor(F.spark_partition_id() / n_files).cast("int"))
    else:
        n_files, n_slices = 1, 1 << 30
        placed = df.withColumn("__arrival", t).withColumn("__slice", slice_by.cast("int")).repartition("__slice")
    placed.sortWithinPartitions("__slice", "__arrival").drop("__arrival").write.partitionBy("__slice").parquet(partial)
    if close and n:
        known = close if isinstance(close, dict) else {}
        end = spark.range(1).select((F.lit(last) + F.expr(END_AFTER)).alias("last")).select(*[(F.col("last") if c == ts else F.lit(known.get(c))).cast(df.schema[c].dataType).alias(c)
                            for c in df.columns])
        end.write.parquet(f"{partial}/__slice={n_slices}")
    _land(spark, partial, path)
    spark.range(1).select(F.lit(str(n_files)).alias("value")).write.text(manifest.toString())
    return n_files


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _land(spark: SparkSession, partial: str, path: str) -> None:
    """Give every file a later modification time than the one before it in order
    of arrival, and the folder its name: as many calls as there are files."""
    fs, at = _file_system(spark, partial)
    files = [f for s in fs.listStatus(at) if s.isDirectory() for f in fs.listStatus(s.getPath())]
    # by slice, then by task: the order of arrival
    files.sort(key=lambda f: (int(f.getPath().getParent().getName().rpartition("=")[2]), f.getPath().getName()))
    newest = max([f.getModificationTime() for f in files], default=0)
    for k, f in enumerate(files):
        fs.setTimes(f.getPath(), newest - 1000 * (len(files) - k), -1)
    if not fs.rename(at, _file_system(spark, path)[1]):
        raise OSError(f"{partial} could not be renamed to {path}")


def read_staged(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_trigger))
                 .option("recursiveFileLookup", "true").parquet(path))


def drained(query) -> list[dict]:
    """Wait for a query's end; the progress of all its batches, by batch. Spark
    keeps the last hundred, so they are gathered while the query runs."""
    seen: dict[int, dict] = {}

    def look() -> None:
        for p in query.recentProgress:
            told = json.loads(p.json)
            seen[told["batchId"]] = told

    while not query.awaitTermination(1):
        look()
    look()
    return [seen[k] for k in sorted(seen)]


def rows_dropped(progress: list[dict]) -> int:
    """WM-4: rows that stateful operators dropped because the watermark had passed them."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p.get("stateOperators", []))


def observed(progress: list[dict], name: str, metric: str) -> int:
    """AGG-11 on a stream: sum of an observed metric over all batches."""
    return sum(dict(p.get("observedMetrics", {})).get(name, {}).get(metric, 0) or 0 for p in progress)


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a new stream's state: as many as keep the cores busy, and
    not more than the session's shuffles have. Each is a RocksDB store of its
    own, opened and committed in every batch, rows or none, which costs more
    than the rows of a small one. A store keeps its state on disk, and a batch
    has at most ``ROWS_PER_BATCH`` rows a source, so tasks stay bounded.
    ``spark.tidepool.stream.statePartitions`` sets another number; a stream
    keeps that of its first run."""
    own = spark.conf.get("spark.tidepool.stream.statePartitions", None)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return int(own) if own else min(most, STATE_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)


def started(writer, spark: SparkSession):
    """Start a stream; it takes its settings from the session as it starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", state_partitions(spark))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def run_append(sdf: DataFrame, out_path: str, ckpt: str, mode: str = "append") -> list[dict]:
    """Drain all available input (``availableNow``) into a Parquet table; returns the progress of its batches."""
    return drained(started(sdf.writeStream.format("parquet").outputMode(mode)
                           .option("path", out_path).option("checkpointLocation", ckpt)
                           .trigger(availableNow=True), sdf.sparkSession))


def run_foreach_batch(sdf: DataFrame, fn, ckpt: str, mode: str = "append") -> list[dict]:
    return drained(started(sdf.writeStream.foreachBatch(fn).outputMode(mode)
                           .option("checkpointLocation", ckpt).trigger(availableNow=True), sdf.sparkSession))


def events_stream(spark: SparkSession, sf_dir: str, name: str, where=None,
                  close: bool | dict = False, late_s: int = 0, slice_by: Column | None = None) -> tuple[DataFrame, str]:
    """Stage ``events`` (optionally filtered; without the raw ``props``) in time
    order and open a stream over it with ``ts`` as TIMESTAMP. ``close``: the
    end of the input closes all windows. ``late_s``: every event arrives up to
    that much after its time (by a hash of its id), so the stream is out of
    order. ``slice_by``: see ``stage_files``. Returns (stream, scratch dir)."""
    from tidepool.sources.tables import load_events

    base = scratch(spark, name)
    ev = load_events(spark, sf_dir).drop("props")
    if where is not None:
        ev = ev.where(where)
    delay = F.pmod(F.xxhash64("event_id"), F.lit(late_s * 1_000_000)) if late_s else None
    arrival = None if delay is None else F.unix_micros("ts") + delay
    n_files = stage_files(ev, f"{base}/input", "ts", close, arrival, slice_by)
    sdf = read_staged(spark, f"{base}/input", ev.schema, n_files).withColumn("ts", F.col("ts").cast("timestamp"))
    return sdf, base
