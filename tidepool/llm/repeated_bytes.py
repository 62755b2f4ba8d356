"""Removal of repeated byte strings by a column-wise multi-document suffix order.

A byte goes when a string of ``length`` bytes that covers it also starts
anywhere else in the corpus, on the input as it is.

*Seeds.* Of the hashes of all ``SEED``-byte strings in a window of ``length``
bytes the smallest is chosen; equal strings of ``length`` bytes choose the same
one, so every repetition shows up as equal seeds, at about one position in 70.
A seed stands for its context, the ``length - SEED`` bytes on either side of it
(all strings of ``length`` bytes around the seed lie inside).

*Equal contexts* are repeated as a whole. They are found by hash, first among
the rows of an Arrow batch, so that a passage that a third of all documents
hold leaves a task as one row per batch, then by a window over the seed.

*Different contexts* of one seed are the multi-document collection: aligned at
the seed, one symbol of every context is inserted per round, from the last
column to the first. A round sorts the suffix order stably by the inserted
symbol (the collection's Burrows-Wheeler step) and updates the common prefix
of neighbours: one more where two neighbours stay neighbours with the same
symbol. Neighbours with a common prefix of ``length`` or more mark a repeated
string that starts in this column. The collection lies as sorted files (the
shuffle's) that each task reads in sequence, a bounded number of contexts at a
time; inserting whole documents would take as many passes over the corpus as
its longest document has bytes.

*Large groups.* A seed with more than ``CONTEXTS`` different contexts is split
exactly: of the ``length - SEED`` further bytes of a repetition around the seed
at least half lie on its left or at least half on its right, so a context goes
under two keys, the seed with half of them on either side. A key held once has
no partner, keys of at most ``CONTEXTS`` contexts are collections, and others
are split again by half of the bytes still open, until none is open and the
equal keys are the repetitions themselves.

Texts are named by their 64-bit hash and length; a text that several rows hold
is repeated as a whole. Defined results: null text is empty; texts under
``length`` bytes lose nothing; repeated rows and null doc_ids are documents
like any other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import likely, table, with_place, written
from tidepool.llm.shingles import _BACK, _BASE, U, mix, pieces, powers

SEED = 64
CONTEXTS = 20_000
PAD = 0xFF  # no byte of UTF-8
_VALUE = np.random.default_rng(20240901).integers(1, 2 ** 63, 256, dtype=np.uint64) * U(2) + U(1)


def window_minima(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by block prefixes and suffixes."""
    n = len(v) - w + 1
    full = np.full(-(-len(v) // w) * w, np.uint64(2 ** 64 - 1))
    full[:len(v)] = v
    block = full.reshape(-1, w)
    left = np.minimum.accumulate(block, axis=1).ravel()
    right = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def seeds(data: np.ndarray, off: np.ndarray, length: int):
    """(seed, context hash, row, position) of the chosen seeds of a piece."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty
    side = length - SEED
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers(len(data), _BASE), out=total[1:])
    back = powers(len(data) + 1, _BACK)
    h = mix((total[SEED:] - total[:-SEED]) * back[:len(data) - SEED + 1])
    low = window_minima((h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), side + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(low)]
    chosen = (low & U(0xFFFFFFFF)).astype(np.int64)[np.arange(len(low)) + length <= off[row + 1]]
    chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])] if len(chosen) else chosen
    row = np.searchsorted(off, chosen, side="right") - 1
    left, right = np.minimum(chosen - off[row], side), np.minimum(off[row + 1] - chosen - SEED, side)
    context = mix((total[chosen + SEED + right] - total[chosen - left]) * back[chosen - left]
                  + mix((left * 4096 + right).astype(np.uint64)))
    return h[chosen], context, row, chosen - off[row]


def merged(group: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of intervals per group, as (group, start, end)."""
    o = np.lexsort((start, group))
    group, start, end = group[o], start[o], end[o]
    wide = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(end + group * wide)
    new = np.ones(len(o), bool)
    new[1:] = start[1:] + group[1:] * wide > reach[:-1]
    at = np.flatnonzero(new)
    return group[at], start[at], np.maximum.reduceat(end, at) if len(at) else end


MARKS = "seed long, context long, text_key long, n int, pos int, until int"


def seed_maker(length: int):
    """Rows of seeds (until 0), one of each context per batch, and of
    intervals already known to be repeated."""
    side = length - SEED

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("text_key").to_numpy()
            found, size = [], np.zeros(b.num_rows, np.int64)
            for at, data, off in pieces(b.column("text")):
                size[at:at + len(off) - 1] = np.diff(off)
                s, c, row, pos = seeds(data, off, length)
                found.append((s, c, row + at, pos))
            s, c, row, pos = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
            _, first, inverse, count = np.unique(mix(s.astype(np.uint64)) ^ c.astype(np.uint64), return_index=True,
                                                 return_inverse=True, return_counts=True)
            twice = count[inverse] > 1
            r, p = row[twice], pos[twice]
            g, lo, hi = merged(r, np.maximum(p - side, 0), np.minimum(p + length, size[r]))
            pseudo = mix((key[g].view(np.uint64) ^ lo.astype(np.uint64)))  # only spreads these rows
            cols = [np.concatenate([s[first].view(np.int64), pseudo.view(np.int64)]),
                    np.concatenate([c[first].view(np.int64), np.zeros(len(g), np.int64)]),
                    key[np.concatenate([row[first], g])]]
            cols += [x.astype(np.int32) for x in (size[np.concatenate([row[first], g])], np.concatenate([pos[first], lo]),
                                                  np.concatenate([np.zeros(len(first), np.int64), hi]))]
            out = pa.record_batch([pa.array(x) for x in cols], names=["seed", "context", "text_key", "n", "pos", "until"])
            for i in range(0, out.num_rows, 50_000):
                yield out.slice(i, 50_000)
    return make


def context_maker(length: int):
    """The bytes around each asked position of a text."""
    side = length - SEED

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, n, text, asks in zip(*(b.column(i).to_pylist() for i in range(4))):
                data = text.encode()
                out = ([], [], [], [])
                for a in asks:
                    p = a["pos"]
                    out[0].append(a["seed"])
                    out[1].append(p)
                    out[2].append(a["alone"])
                    left, right = data[max(0, p - side):p], data[p:p + length]
                    out[3].append(b"\xff" * (side - len(left)) + left + right + b"\xff" * (length - len(right)))
                m = len(asks)
                yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array([key] * m, pa.int64()), pa.array([n] * m, pa.int32()),
                                       pa.array(out[1], pa.int32()), pa.array(out[2], pa.bool_()), pa.array(out[3], pa.binary())],
                                      names=["seed", "text_key", "n", "pos", "alone", "bytes"])
    return make


def insert_columns(symbols: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last column at which each string has a repeated string of
    ``length`` (last -1: none). ``symbols``: strings x columns; strings match
    only inside their ``group``."""
    m, columns = symbols.shape
    first, last = np.full(m, columns), np.full(m, -1)
    order = np.argsort(group, kind="stable")  # of the empty suffixes
    prefix = np.zeros(m, np.int64)            # with the neighbour before
    rank = np.unique(group, return_inverse=True)[1]
    starts = np.ones(m, bool)
    starts[1:] = rank[order][1:] != rank[order][:-1]
    for column in range(columns - 1, -1, -1):
        symbol = symbols[order, column]
        by = np.argsort(symbol, kind="stable")
        by = by[np.argsort(rank[order[by]].astype(np.uint16 if m < 65536 else np.int64), kind="stable")]
        s, was = symbol[by], order
        order = order[by]
        same = ~starts
        same[1:] &= s[1:] == s[:-1]
        same[0] = False
        stay = same.copy()
        stay[1:] &= by[1:] == by[:-1] + 1
        new = np.where(stay, prefix[by] + 1, 0)
        far = np.flatnonzero(same & ~stay)  # new neighbours: compare their bytes
        for i in range(0, len(far), 4096):
            f = far[i:i + 4096]
            equal = symbols[order[f], column:] == symbols[order[f - 1], column:]
            new[f] = np.where(equal.all(1), columns - column, equal.argmin(1))
        prefix = new
        if column + length <= columns:
            hit = prefix >= length
            hit[:-1] |= hit[1:]
            at = order[hit]
            at = at[(symbols[at, column] != PAD) & (symbols[at, column + length - 1] != PAD)]
            first[at] = column
            last[at] = np.maximum(last[at], column)
    return first, last


def collection_maker(length: int, contexts: int = CONTEXTS):
    """Contexts in order of their seed -> repeated intervals of their texts."""
    side = length - SEED

    def solve(rows: list) -> pa.RecordBatch:
        seed, key, n, pos, alone, data = zip(*rows)
        symbols = np.frombuffer(b"".join(data), np.uint8).reshape(len(rows), side + length)
        first, last = insert_columns(symbols, np.array(seed, np.int64), length)
        i = np.flatnonzero((last >= 0) & np.array(alone))
        p = np.array(pos, np.int64)[i] - side
        return pa.record_batch([pa.array(np.array(key, np.int64)[i]), pa.array(np.array(n, np.int32)[i]),
                                pa.array((p + first[i]).astype(np.int32)), pa.array((p + last[i] + length).astype(np.int32))],
                               names=["text_key", "n", "pos", "until"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for b in batches:
            rows = list(zip(*(b.column(i).to_pylist() for i in range(6))))
            for row in rows:
                if len(held) >= contexts and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)
    return run


def split_groups(spark: SparkSession, contexts: DataFrame, length: int, limit: int) -> tuple[DataFrame | None, DataFrame]:
    """Groups of at most ``limit`` contexts that hold, together with the second
    table's intervals, every repetition among the contexts of equal seeds."""
    side, cols = length - SEED, ["text_key", "n", "pos", "alone", "bytes"]
    level = written(spark, contexts.select("seed", *cols, F.lit(0).alias("left"), F.lit(0).alias("right")), "split")
    open_, groups = side, None
    while open_ and not level.isEmpty():
        half = -(-open_ // 2)
        open_ -= half
        two = F.array(F.struct((F.col("left") + half).alias("left"), F.col("right").alias("right")),
                      F.struct(F.col("left").alias("left"), (F.col("right") + half).alias("right")))
        keyed = level.select("seed", *cols, F.explode(two).alias("to")).select("seed", *cols, "to.*")
        held = F.substring("bytes", F.lit(side + 1) - F.col("left"), F.col("left") + F.col("right") + SEED)
        keyed = keyed.withColumn("held", held).where("substring(held, 1, 1) != X'FF' AND substring(held, -1, 1) != X'FF'")
        keyed = written(spark, keyed.select(F.xxhash64("seed", "left", "right", "held").alias("seed"), *cols, "left", "right"), "split")
        size = keyed.groupBy("seed").agg(F.count("*").alias("size")).where("size > 1")
        sized = written(spark, keyed.join(size, "seed"), "split")
        if not open_:
            level = sized
            break
        few = sized.where(F.col("size") <= limit).select("seed", *cols)
        groups = few if groups is None else groups.unionByName(few)
        level = sized.where(F.col("size") > limit).drop("size")
    start = F.col("pos") - F.col("left")
    whole = level.where("alone").select("text_key", "n", start.cast("int").alias("pos"), (start + length).cast("int").alias("until"))
    return groups, whole


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_text binary, kept_sha256 string"


def cutter(keep_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for doc, text, spans in zip(*(b.column(i).to_pylist() for i in range(3))):
                data, kept, at, removed, runs = text.encode(), [], 0, 0, 0
                for s in sorted((x["pos"], x["until"]) for x in spans or ()):
                    if s[0] > at or not runs:
                        kept.append(data[at:s[0]])
                        runs += 1
                        removed += s[1] - s[0]
                        at = s[1]
                    elif s[1] > at:
                        removed += s[1] - at
                        at = s[1]
                kept = b"".join([*kept, data[at:]])
                out.append((doc, len(data), removed, runs, kept if keep_text else None, hashlib.sha256(kept).hexdigest()))
                held += len(kept) if keep_text else 0
                if held > 8 << 20:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)
    return cut


def _batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.string()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                           names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256"])


def remove_repeated(spark: SparkSession, docs: DataFrame, length: int = 200, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_text
    (null unless ``keep_text``), kept_sha256."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = with_place(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))).withColumn(
        "text_key", F.xxhash64("text")).withColumn("n", F.octet_length("text"))
    texts = named.groupBy("text_key", "n").agg(F.count("*").alias("rows"), F.min(F.struct("place_file", "place_row")).alias("at"))
    texts = written(spark, texts, "texts")

    found = named.select("text_key", "text").mapInArrow(seed_maker(length), MARKS)
    by_seed, by_context = Window.partitionBy("seed"), Window.partitionBy("seed", "context")
    marks = (found.withColumn("same", F.count("*").over(by_context))
             .withColumn("nth", F.row_number().over(by_context.orderBy("text_key", "pos")))
             .withColumn("all", F.count("*").over(by_seed))
             .withColumn("many", F.sum(F.expr("int(until = 0 AND nth = 1)")).over(by_seed) > CONTEXTS)
             .where("until > 0 OR all > 1")
             .withColumn("ask", F.expr("until = 0 AND all > same AND nth = 1"))
             .select("seed", "text_key", "n", "pos", "until", "same", "ask", F.expr("ask AND many").alias("many")))
    marks = written(spark, marks, "marks")

    side = length - SEED
    known = marks.where("until > 0 OR same > 1").select(
        "text_key", "n", F.when(F.col("until") > 0, F.col("pos")).otherwise(F.greatest(F.col("pos") - side, F.lit(0))).alias("pos"),
        F.when(F.col("until") > 0, F.col("until")).otherwise(F.least(F.col("pos") + length, F.col("n"))).alias("until"))
    copies = texts.where((F.col("rows") > 1) & (F.col("n") >= length)).select(
        "text_key", "n", F.lit(0).alias("pos"), F.col("n").alias("until"))

    def contexts(marked: DataFrame) -> DataFrame:
        asks = (marked.groupBy("text_key", "n")
                .agg(F.collect_list(F.struct("seed", "pos", (F.col("same") == 1).alias("alone"))).alias("asks"))
                .join(texts.select("text_key", "n", "at.place_file", "at.place_row"), ["text_key", "n"]))
        asks = written(spark, asks, "asks")
        return (named.select("place_file", "place_row", "text").where(likely(spark, asks, ["place_file", "place_row"])).join(asks, ["place_file", "place_row"]).select("text_key", "n", "text", "asks")
                .mapInArrow(context_maker(length), "seed long, text_key long, n int, pos int, alone boolean, bytes binary"))

    def repeated(groups: DataFrame) -> DataFrame:
        return (groups.repartition("seed").sortWithinPartitions("seed")
                .mapInArrow(collection_maker(length, CONTEXTS), "text_key long, n int, pos int, until int"))

    partial = repeated(contexts(marks.where("ask AND NOT many")))
    if not marks.where("many").isEmpty():
        groups, whole = split_groups(spark, contexts(marks.where("many")), length, CONTEXTS)
        partial = partial.unionByName(whole)
        if groups is not None:
            partial = partial.unionByName(repeated(groups))

    spans = (known.unionByName(copies).unionByName(partial).groupBy("text_key", "n")
             .agg(F.collect_set(F.struct("pos", "until")).alias("spans")))
    spans = written(spark, spans, "spans")
    held = likely(spark, spans, ["text_key", "n"])  # other texts lose nothing and are not moved
    rows = named.select("doc_id", "text", "text_key", "n")
    some = rows.where(held).join(spans, ["text_key", "n"], "left").select("doc_id", "text", "spans")
    none = rows.where(~held).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return some.unionByName(none).mapInArrow(cutter(keep_text), CUT)


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated(spark, table(spark, sf_dir, "documents"), 200, keep_text=False)
    return out.drop("kept_text")
