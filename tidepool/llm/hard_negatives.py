"""Hard negatives by anchor-clustered shared candidate lists (as in MAXIMUS).

Vectors are integers. An anchor's positives are its best rows of the same label;
for each positive its hard negatives are the best rows of other labels whose
score (inner product) lies in a band below the positive's.

Anchors are clustered by direction. For a cluster with centre c, whose members
are at most the angle t away from c, no member a scores more than
``|a| |x| cos(max(0, angle(x, c) - t))`` with a candidate x. Candidates are
sorted by this bound (without ``|a|``) once for the cluster, and all members
walk that one list, a stretch at a time, until the bound is under what they
still need: the score of the last of their best so far, or the lower end of the
band. What a member has then is certified to be complete.

On Spark, candidates lie in blocks by a hash of their id and anchors in groups
of clusters; a cell joins one block with one group and is all that a task holds
(``CELL_BYTES`` of candidates, ``CHUNK * CHUNKS`` anchors). A cluster's list is
sorted block by block. Large clusters, such as many copies of one vector, are
dealt by a hash of the id into chunks, each with its own angle. Best rows of the
blocks are merged by ranking them. Two passes: positives, then negatives, whose
bands follow from the positives. The work grows with anchors times candidates,
less what the bounds save.

Fitted on a sample: the centres, on ``SAMPLE`` anchors. They decide the order of
the walk only, never the rows.

Defined results: rows with a null id, a null label, a null vector or a null or
non-finite component take no part, nor do vectors so long that a hundredfold
score would pass a 64-bit integer (length of 2^27 and more in units of 1/scale);
of rows that share an id the one with the smallest label, then the smallest
vector bytes takes part; vectors of unequal lengths are filled up with zeros; an
empty vector scores 0; ties go to the smaller id; an anchor without positives,
and a positive without negatives in its band, give no rows; so does an empty
table. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import drop_written, table, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # band of a negative's score in hundredths of its positive's
CELL_BYTES = 16 << 20  # candidates of a cell, four bytes a component
SMALL_BLOCK = 1024  # rows of a block under which more tasks do not help
SAMPLE, MOST_CLUSTERS, MEMBERS = 4096, 256, 64
CHUNK, CHUNKS = 256, 32  # members that walk together, chunks of a group
STEP = 512  # entries of a list between two looks at the bound
LONGEST = 2.0 ** 27
LEAST = np.iinfo(np.int64).min


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, label, q (components ``floor(SCALE * x)`` as four-byte integers) of
    the rows that take part."""
    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            offsets = lists.offsets.to_numpy()
            raw = lists.values
            x = np.asarray(raw.to_numpy(zero_copy_only=False), np.float64)  # null: NaN
            with np.errstate(invalid="ignore", over="ignore"):
                y = np.floor(SCALE * x)
                wrong = np.concatenate([[0], np.cumsum(~np.isfinite(y))])
                square = np.concatenate([[0.0], np.cumsum(np.where(np.abs(y) < LONGEST, y * y, LONGEST ** 2))])
            begin, end = offsets[:-1], offsets[1:]
            fits = (wrong[end] == wrong[begin]) & (square[end] - square[begin] < LONGEST ** 2)
            rows = np.flatnonzero(fits)
            whole = np.where(np.isfinite(y) & (np.abs(y) < LONGEST), y, 0).astype("<i4")
            q = [whole[begin[r]:end[r]].tobytes() for r in rows.tolist()]
            at = pa.array(rows)
            yield pa.record_batch([b.column(0).take(at), b.column(1).take(at), pa.array(q, pa.binary())], names=["vec_id", "label", "q"])

    some = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    some = some.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    told = some.mapInArrow(scale, "vec_id long, label long, q binary")
    return told.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("v")).select("vec_id", "v.label", "v.q")


def matrix(q: list[bytes], width: int | None = None) -> np.ndarray:
    """Vectors as rows of integers, filled up with zeros to the longest."""
    lengths = np.array([len(x) // 4 for x in q], np.int64)
    out = np.zeros((len(q), max(width or 0, int(lengths.max(initial=0)))), np.float64)
    if len(q) and (lengths == lengths[0]).all():
        out[:, :lengths[0]] = np.frombuffer(b"".join(q), "<i4").reshape(len(q), -1)
    else:
        for i, x in enumerate(q):
            out[i, :lengths[i]] = np.frombuffer(x, "<i4")
    return out


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def centres(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means."""
    u = unit(sample)
    c = u[:k].copy()
    for _ in range(rounds):
        near = np.argmax(u @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        held = np.bincount(near, minlength=k) > 0
        c[held] = unit(total[held])
    return c


def clustered(spark: SparkSession, anchors: DataFrame) -> tuple[DataFrame, int]:
    """Anchors with their chunk and their group; the number of groups."""
    n = anchors.count()
    sample = [r.q for r in anchors.orderBy(F.xxhash64("vec_id"), "vec_id").select("q").limit(SAMPLE).collect()]
    points = matrix(sample)
    k = max(1, min(MOST_CLUSTERS, n // MEMBERS, len(sample)))
    c = centres(points, k) if len(sample) else np.zeros((1, 0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = matrix(b.column("q").to_pylist(), c.shape[1])
            near = np.argmax(m[:, :c.shape[1]] @ c.T, axis=1) if b.num_rows else []
            yield pa.record_batch([*b.columns, pa.array(near, pa.int32())], names=[*b.schema.names, "cluster"])

    told = written(spark, anchors.mapInArrow(assign, "vec_id long, label long, q binary, cluster int"), "anchors")
    parts = [1] * k
    for r in told.groupBy("cluster").count().collect():  # a row a cluster
        parts[r["cluster"]] = -(-r["count"] // CHUNK)
    first = np.cumsum([0, *parts])
    lookup = [F.element_at(F.array(*[F.lit(int(x)) for x in xs]), F.col("cluster") + 1) for xs in (first[:-1], parts)]
    chunk = (lookup[0] + F.pmod(F.xxhash64("vec_id"), lookup[1])).cast("int")
    told = told.select("vec_id", "label", "q", chunk.alias("chunk"))
    return told.withColumn("group", F.floor(F.col("chunk") / CHUNKS).cast("int")), max(1, -(-int(first[-1]) // CHUNKS))


class Best:
    """The ``k`` best (score, id) of each of ``m`` rows so far."""

    def __init__(self, m: int, k: int):
        self.score, self.id = np.full((m, k), LEAST, np.int64), np.full((m, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``scores[i, j]``: of row ``rows[i]`` with ``ids[j]``, where ``allowed[i, j]``."""
        k = self.score.shape[1]
        last, last_id = self.score[rows, -1][:, None], self.id[rows, -1][:, None]
        allowed = allowed & ((scores > last) | (scores == last) & (ids < last_id))
        if scores.shape[1] > k:
            there = np.where(allowed, scores, LEAST)
            allowed &= there >= np.partition(there, -k, axis=1)[:, -k][:, None]
        i, j = np.nonzero(allowed)
        if not len(i):
            return
        touched = np.unique(i)
        row = np.concatenate([rows[i], np.repeat(rows[touched], k)])
        score = np.concatenate([scores[i, j], self.score[rows[touched]].ravel()])
        which = np.concatenate([ids[j], self.id[rows[touched]].ravel()])
        order = np.lexsort((which, ~score, row))  # ~: highest first
        row, score, which = row[order], score[order], which[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < k
        self.score[row[kept], place[kept]], self.id[row[kept], place[kept]] = score[kept], which[kept]


class Cell:
    """A block of candidates, for the clusters that walk it."""

    def __init__(self, candidates: pa.Table):
        self.id, self.label = (candidates.column(c).to_numpy() for c in ("vec_id", "label"))
        self.x = matrix(candidates.column("q").to_pylist())
        self.length = np.linalg.norm(self.x, axis=1)
        self.unit = unit(self.x)

    def shared_list(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates by their bound for these members, highest first (equal ones
        by id), and the bounds. A little is added for rounding."""
        u = unit(members)
        u = u[np.abs(u).sum(axis=1) > 0]
        if not len(u):
            return np.argsort(self.id), np.zeros(len(self.id))
        centre = unit(u.sum(axis=0, keepdims=True))[0]
        apart = np.arccos(np.clip(u @ centre, -1, 1)).max()
        away = np.arccos(np.clip(self.unit @ centre, -1, 1))
        bound = self.length * (np.cos(np.maximum(0, away - apart)) + 1e-6)
        order = np.lexsort((self.id, -bound))
        return order, bound[order]

    def walk(self, members: np.ndarray, need, look) -> None:
        """``look(rows, scores, entries)`` for stretches of the shared list, with
        the members that still need what the bound allows; ``need(rows)``: the
        score under which nothing can change for these members."""
        width = max(members.shape[1], self.x.shape[1])
        members = np.pad(members, ((0, 0), (0, width - members.shape[1])))
        x = self.x if self.x.shape[1] == width else np.pad(self.x, ((0, 0), (0, width - self.x.shape[1])))
        order, bound = self.shared_list(members) if width == self.unit.shape[1] else Cell.widened(self, width).shared_list(members)
        length = np.linalg.norm(members, axis=1)
        exact = length.max(initial=0) * self.length.max(initial=0) < 2.0 ** 52  # no partial sum is rounded
        rows = np.arange(len(members))
        for lo in range(0, len(order), STEP):
            least = need(rows)
            rows = rows[(length[rows] * bound[lo] + 1 >= least)]
            if not len(rows):
                return
            some = order[lo:lo + STEP]
            scores = (members[rows] @ x[some].T if exact else members[rows].astype(np.int64) @ x[some].T.astype(np.int64)).astype(np.int64)
            look(rows, scores, some)

    def widened(self, width: int) -> Cell:
        out = object.__new__(Cell)
        out.id, out.label, out.length = self.id, self.label, self.length
        out.unit = np.pad(self.unit, ((0, 0), (0, width - self.unit.shape[1])))
        return out


def chunks(anchors: pa.Table) -> Iterator[pa.Table]:
    chunk = anchors.column("chunk").to_numpy()
    for c in np.unique(chunk):
        yield anchors.take(pa.array(np.flatnonzero(chunk == c)))


def best_positives(k: int):
    """Cell function: the ``k`` best rows of the block with the anchor's label."""
    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows:
            cell = Cell(candidates)
            for part in chunks(anchors):
                own, label = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                best = Best(len(own), k)

                def look(rows, scores, some):
                    allowed = (label[rows][:, None] == cell.label[some]) & (own[rows][:, None] != cell.id[some])
                    best.add(rows, scores, allowed, cell.id[some])

                cell.walk(matrix(part.column("q").to_pylist()), lambda rows: best.score[rows, -1].astype(np.float64), look)
                i, j = np.nonzero(best.score > LEAST)
                out.append((own[i], best.id[i, j], best.score[i, j]))
        return _table(["anchor_id", "positive_id", "positive_score"], out)

    return run


def best_negatives(k: int, low: int, high: int):
    """Cell function: for each positive the ``k`` best rows of the block with
    another label and a score in the positive's band."""
    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows:
            cell = Cell(candidates)
            for part in chunks(anchors):
                own, label = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                positives = part.column("positives").to_pylist()  # (positive_score, positive_id), best first
                most = max(map(len, positives))
                score = np.array([[p["positive_score"] for p in ps] + [LEAST] * (most - len(ps)) for ps in positives], np.int64)
                there = score > LEAST
                floor = np.where(there, -((-low * np.where(there, score, 0)) // 100), 1)
                top = np.where(there, (high * np.where(there, score, 0)) // 100, 0)  # floor over top: nothing fits
                best = [Best(len(own), k) for _ in range(most)]

                def need(rows):
                    least = [np.where(floor[rows, p] > top[rows, p], np.inf, np.maximum(floor[rows, p], best[p].score[rows, -1])) for p in range(most)]
                    return np.min(least, axis=0)

                def look(rows, scores, some):
                    other = label[rows][:, None] != cell.label[some]
                    for p in range(most):
                        allowed = other & (scores >= floor[rows, p][:, None]) & (scores <= top[rows, p][:, None])
                        if allowed.any():
                            best[p].add(rows, scores, allowed, cell.id[some])

                cell.walk(matrix(part.column("q").to_pylist()), need, look)
                for p in range(most):
                    i, j = np.nonzero(best[p].score > LEAST)
                    ids = np.array([positives[a][p]["positive_id"] for a in i.tolist()], np.int64)
                    out.append((own[i], ids, score[i, p], best[p].id[i, j], best[p].score[i, j]))
        return _table(["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"], out)

    return run


def _table(names: list[str], parts: list[tuple]) -> pa.Table:
    columns = zip(*parts) if parts else [[np.array([], np.int64)] for _ in names]
    return pa.table([pa.array(np.concatenate(list(c)).astype(np.int64)) for c in columns], names=names)


def _cells(vectors: DataFrame, anchors: DataFrame, n_blocks: int, n_groups: int, run, schema: str) -> DataFrame:
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", "label", "q", block, every(n_groups).alias("group"))
    right = anchors.select("*", every(n_blocks).alias("block"))
    return left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(run, schema)


def _first(rows: DataFrame, of: list[str], score: str, which: str, k: int) -> DataFrame:
    """The ``k`` best rows of each ``of``, numbered from 1."""
    w = Window.partitionBy(*of).orderBy(F.col(score).desc(), which)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``vectors``: vec_id, label, embedding. One row per anchor, positive and
    negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    v = written(spark, scaled(vectors), "vectors")
    n, width = v.agg(F.count("*"), F.coalesce(F.max(F.length("q")), F.lit(0))).first()
    fitting = max(SMALL_BLOCK, CELL_BYTES // max(width, 4))
    n_blocks = max(1, -(-n // fitting), min(-(-n // SMALL_BLOCK), 2 * spark.sparkContext.defaultParallelism))
    anchors, n_groups = clustered(spark, v.where(is_anchor))

    found = _cells(v, anchors, n_blocks, n_groups, best_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = _first(found, ["anchor_id"], "positive_score", "positive_id", positives)
    lists = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("positive_score", "positive_id")), asc=False).alias("positives"))
    asking = written(spark, anchors.join(lists, "vec_id"), "asking")
    found = _cells(v, asking, n_blocks, n_groups, best_negatives(negatives, low, high),
                   "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark, rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
