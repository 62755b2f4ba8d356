"""Exact duplicate removal over an extendible-hash index on shared files.

The leading bits of a text's 64-bit hash name its bucket. A directory maps
every prefix of ``global depth`` bits to a bucket; a bucket that holds more
than ``capacity`` bytes of different texts splits on one bit more, and the
directory doubles when a bucket is as deep as itself. Copies of one text cannot
be split by more bits, so each counts once. Buckets are ranges of hash values;
the task that owns a bucket chains the texts of equal hash, compares their
bytes, and writes the bucket's entries (hash, chain position, text, row to
keep, group size) as files in the shared folder.

Copies are combined per Arrow batch before the shuffle, so a text that makes
up a third of all rows arrives as one entry per batch. Rows meet their entry
by (hash, SHA-256), a join that Spark splits where it is skewed. The directory
has one entry per ``capacity`` bytes (at 100 TB about 1.6 million of 64 MB) and
is the only thing that reaches the driver.

Defined results: null text counts as empty; the row with the largest doc_id of
a group stays (null doc_ids are smallest); of fully repeated rows exactly one
stays; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import new_path, table, written

CAPACITY = 64 << 20
STEP = 6
MAX_DEPTH = 24  # a bucket at this depth grows beyond its capacity; its owner reads it in sequence
MAX_BROADCAST_SLOTS = 1 << 20

ENTRY = "bucket int, h long, text string, n long, keep_id long"
INDEX = "bucket int, h long, chain int, text_sha256 string, text string, keep_id long, group_size long"


def directory(keys: DataFrame, capacity: int) -> list[tuple[int, int]]:
    """Buckets as (depth, prefix), in order of key range. ``keys``: distinct
    ``h`` with ``bytes``. Prefix sums are read ``STEP`` bits at a time, and only
    below buckets that are too full."""
    done: list[tuple[int, int]] = []
    full = [(0, 0)]
    while full:
        depth = full[0][0]
        deeper = min(64, depth + STEP)
        want = F.shiftrightunsigned("h", 64 - depth).isin([p for _, p in full]) if depth else F.lit(True)
        sums = {r.p: (r.b, r.n) for r in keys.where(want).groupBy(F.shiftrightunsigned("h", 64 - deeper).alias("p"))
                .agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()}
        full = []
        todo = [(depth, p) for p in sorted({p >> (deeper - depth) for p in sums})] or [(0, 0)]
        while todo:
            d, p = todo.pop()
            lo, hi = p << (deeper - d), (p + 1) << (deeper - d)
            held, n = (sum(x) for x in zip((0, 0), *(sums[x] for x in range(lo, hi) if x in sums)))
            if held <= capacity or n <= 1 or d >= MAX_DEPTH:
                done.append((d, p))
            elif d < deeper:
                todo += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
            else:
                full.append((d, p))
    return sorted(done, key=lambda x: x[1] << (64 - x[0]))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry for each different text of a batch."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["bucket", "h", "text"]).aggregate([([], "count_all"), ("doc_id", "max")])
        yield from pa.table({"bucket": t["bucket"], "h": t["h"], "text": t["text"].cast(pa.string()),
                             "n": t["count_all"], "keep_id": t["doc_id_max"]}).combine_chunks().to_batches(max_chunksize=2000)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of (bucket, h): chain equal hashes, compare bytes."""
    at, chain, out, held = None, {}, [], 0

    def close() -> None:
        for i, (text, (n, keep)) in enumerate(chain.items()):
            out.append((*at, i, hashlib.sha256(text.encode()).hexdigest(), text, keep, n))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)],
                               names=["bucket", "h", "chain", "text_sha256", "text", "keep_id", "group_size"])

    for b in batches:
        for bucket, h, text, n, keep in zip(*(b.column(i).to_pylist() for i in range(5))):
            if (bucket, h) != at:
                close()
                at, chain = (bucket, h), {}
            was_n, was = chain.get(text, (0, None))  # equal keys of a dict: equal bytes
            chain[text] = (was_n + n, keep if was is None else was if keep is None else max(was, keep))
            held += len(text)
            if held > 8 << 20 and out:
                yield flush()
                out, held = [], 0
    close()
    if out:
        yield flush()


def build_index(spark: SparkSession, rows: DataFrame, docs: DataFrame, capacity: int = CAPACITY) -> str:
    """Write the index files of ``docs(h, text, doc_id)``; returns their folder."""
    keys = rows.groupBy("h").agg(F.max("n_bytes").alias("bytes"))
    buckets = directory(keys, capacity)
    deep = max(d for d, _ in buckets)  # the directory's depth
    slots = spark.createDataFrame([(i, p << (deep - d), ((p + 1) << (deep - d)) - 1) for i, (d, p) in enumerate(buckets)],
                                  "bucket int, lo long, hi long")
    slots = slots.select(F.explode(F.sequence("lo", "hi")).alias("slot"), "bucket")
    slot = F.shiftrightunsigned("h", 64 - deep) if deep else F.lit(0).cast("long")
    if 2 ** deep <= MAX_BROADCAST_SLOTS:  # else the rows are shuffled to the directory
        slots = F.broadcast(slots)
    placed = docs.withColumn("slot", slot).join(slots, "slot")
    entries = placed.select("bucket", "h", "text", "doc_id").mapInArrow(_combine, ENTRY)
    path = new_path(spark, "hash-index")
    (entries.repartitionById(len(buckets), "bucket").sortWithinPartitions("bucket", "h").mapInArrow(_own, INDEX)
     .write.option("compression", "zstd").parquet(path))
    return path


def exact_dedup(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    rows = written(spark, plain.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"),
                                       F.octet_length("text").cast("long").alias("n_bytes"),
                                       F.monotonically_increasing_id().alias("row")), "dedup-rows")
    index = spark.read.schema(INDEX).parquet(build_index(spark, rows, plain, capacity))
    entry = index.select("h", "text_sha256", "keep_id", "group_size")
    same = Window.partitionBy("text_sha256", "doc_id").orderBy("row")
    return (rows.join(entry, ["h", "text_sha256"])
            .withColumn("nth", F.row_number().over(same))
            .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
