"""Sharding by longest-processing-time scheduling.

Groups that must stay together (rows with the same key) are sorted by size and
go, largest first, to the least-loaded shard through a heap. A heap over every
group of a large corpus would pass the whole corpus through one process, so
the items of the heap are

* every group of at least ``total / (shards * grain)`` bytes by itself: by
  that definition there are at most ``shards * grain`` of them;
* the smaller groups in bundles: a hash of the group names its bundle, and the
  bundles come in ``levels`` of halving size (``bundles`` of each), so that the
  heap ends with very fine items and the shards come out nearly equal.

Both tables are bounded by parameters (16,384 and 14,336 rows by default), not
by the data; only they reach the driver, and only they are broadcast. Rows are
moved once, as digests without text, to number the slots of each shard.

Defined results: a null text counts as empty (size 1) and shares the group of
empty texts; null or repeated doc_ids and repeated rows keep one row each in
the result; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import table, written

CELL_ROWS = 50_000


def longest_first(items: list[tuple[int, object]], n_shards: int) -> dict[object, int]:
    """Item name -> shard: items by falling size (ties by name) to the shard
    with the least bytes so far (ties to the lowest shard)."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for size, name in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, shard = heapq.heappop(heap)
        out[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def assign_shards(spark: SparkSession, sized: DataFrame, n_shards: int, grain: int = 1024,
                  bundles: int = 2048, levels: int = 7) -> DataFrame:
    """Add ``shard`` to ``sized``, which has ``group_key`` (string) and ``size``
    (long). Equal keys share a shard."""
    h = F.xxhash64("group_key")
    r = F.greatest(F.pmod(h, F.lit(2 ** levels)), F.lit(1))
    bundle = ((F.lit(levels - 1) - F.floor(F.log2(r.cast("double")))) * bundles
              + F.pmod(F.shiftright(h, 16), F.lit(bundles))).cast("int")
    rows = sized.withColumn("bundle", bundle)
    groups = rows.groupBy("group_key", "bundle").agg(F.sum("size").alias("bytes"))
    groups = written(spark, groups, "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    least = max(1, -(-total // (n_shards * grain)))
    heavy = groups.where(F.col("bytes") >= least).select("group_key", "bytes").collect()  # <= n_shards * grain rows
    tail = groups.where(F.col("bytes") < least).groupBy("bundle").agg(F.sum("bytes").alias("bytes")).collect()
    shard = longest_first([(x.bytes, ("g", x.group_key)) for x in heavy] + [(x.bytes, ("b", x.bundle)) for x in tail],
                          n_shards)
    own = spark.createDataFrame([(x.group_key, shard["g", x.group_key]) for x in heavy],
                                "group_key string, own int").coalesce(1)
    shared = spark.createDataFrame([(x.bundle, shard["b", x.bundle]) for x in tail],
                                   "bundle int, shared int").coalesce(1)
    # both sides are bounded by the parameters above
    return (rows.join(F.broadcast(own), "group_key", "left").join(F.broadcast(shared), "bundle", "left")
            .withColumn("shard", F.coalesce("own", "shared")).drop("own", "shared", "bundle"))


def number_slots(spark: SparkSession, sharded: DataFrame, row: str, n_rows: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard. A shard is numbered in
    cells of about ``CELL_ROWS`` rows (by a hash of the unique ``row``), each
    shifted by the rows of the cells before it, so no task holds a shard."""
    n_cells = max(1, n_rows // CELL_ROWS)
    cells = sharded.withColumn("cell", F.pmod(F.xxhash64(row), F.lit(n_cells)).cast("int"))
    counts = cells.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "cell").orderBy("doc_id", row)
    return (cells.withColumn("rank", F.row_number().over(own)).join(shift, ["shard", "cell"])
            .withColumn("slot", F.col("before") + F.col("rank") - 1).drop("cell", "rank", "before"))


def shard_documents(spark: SparkSession, docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard. Law ``bytes``: the shards' sizes are nearly equal."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = docs.select(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("group_key"),
                         F.monotonically_increasing_id().alias("row"))
    digest = written(spark, digest, "shard-digest")
    sharded = assign_shards(spark, digest, n_shards)
    out = number_slots(spark, sharded, "row", digest.count())
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark, table(spark, sf_dir, "documents"), 16)
