"""Similarity join of shingle sets by a count-vector R-tree.

The tokens of a set (word shingles) are hashed into groups, and the counts per
group are the set's point. The overlap of two sets is at most the sum over the
groups of the smaller count, and the overlap of anything below two R-tree nodes
at most the same sum over the corners of their boxes; pairs whose bound is
under ``t/(1+t) (|A|+|B|)`` are pruned, the others are verified on the sets.

One tree over a corpus cannot be searched by one task, so points are first
routed on very fine groups. The tokens of a set stand in one fixed order, and
the set is routed by its first ``2 (1-t) n + 1`` pairs of neighbours in it: sets
of similarity t share one of those (see ``route_keys``), while sets that share
a few tokens by chance or through a passage hardly ever have two of them side
by side. A single shared token must not be enough: in a large corpus nearly
every long text shares one with some other, and all become one subtree. The
order puts tokens first that are rare by an estimate: shingles that a bounded
sample of documents holds three times or more come last, the others stand by
the frequency of their words in the sample. The order decides only how many
candidates there are; every order is exact.

Sets that meet, directly or over others, form a candidate subtree. A subtree
is cut into leaves of at most ``LEAF`` points by size and hash, which are joined
pairwise, first on points, then, for what is left, on whole sets. A leaf pair
returns a spanning forest of its links, never all pairs, and skips pairs that it
has connected already. Identical sets are one point. Of a subtree with many
leaves each is first joined with itself and one other: near copies become one
component by that, and only what is not in the subtree's largest component
takes part in the remaining leaf pairs (see ``linked``). So groups of thousands
of near copies cost no quadratic work and no task holds more than two leaves;
points outside the largest component still meet all others leaf by leaf.

Defined results: null and empty texts, and texts without words, have an empty
set, are linked with nothing and are their own component; null doc_ids take
part (component_id is the smallest non-null one); repeated rows are equal sets;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import components, likely, merged, small_batches, table, with_place, written
from tidepool.llm.shingles import U, mix, pieces, shingle_hashes, word_hashes

LEAF = 512
LEAF_TOKENS = 400_000
SAMPLE_DOCS = 10_000
PIECE = 1 << 19  # bytes of text looked at together, each with some 60 bytes of arrays
SEEN = 40_000  # sets that a task remembers
_COMMON = 63


def groups_of(n: int) -> int:
    """Groups of a set of ``n`` tokens: a power of two of about n / 6, so that
    the bound tells unrelated sets of any size apart; 64 to 4096."""
    return 1 << min(12, max(6, (n * 4 // 25).bit_length()))


def point(ids: np.ndarray) -> np.ndarray:
    g = groups_of(len(ids))
    return np.bincount((ids & U(g - 1)).astype(np.int64), minlength=g).astype(np.int32)


def packed(p: np.ndarray) -> bytes:
    """A byte a group where that is enough, else four."""
    return b"\1" + p.astype(np.uint8).tobytes() if p.max(initial=0) < 256 else b"\4" + p.tobytes()


def unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8 if b[0] == 1 else np.int32, offset=1).astype(np.int32)


def folded(p: np.ndarray, g: int) -> np.ndarray:
    """The point on ``g`` groups, a divisor of its own number."""
    return p.reshape(-1, g).sum(0)


class TokenOrder:
    """Token id = rarity class (6 bits), then hash: sorting ids sorts by
    estimated rarity."""

    def __init__(self, word_level: np.ndarray, common: np.ndarray, k: int):
        self.word_level, self.common, self.k = word_level, common, k

    def sets(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, sorted token ids) of every text."""
        for at, data, off in pieces(texts, PIECE):
            words, first = word_hashes(data, off)
            h, start, row = shingle_hashes(words, first, self.k)
            level = self.word_level[words & U(0xFFFF)].astype(np.int64)
            run = np.concatenate([[0], np.cumsum(level)])
            rank = np.minimum((run[np.minimum(start + self.k, first[1:][row])] - run[start]) * 62 // (15 * self.k), 62)
            if len(self.common):
                i = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
                rank[self.common[i] == h] = _COMMON
            ids = (rank.astype(np.uint64) << U(58)) | (h >> U(6))
            ends = np.searchsorted(row, np.arange(len(off)))
            for r in range(len(off) - 1):
                yield at + r, np.unique(ids[ends[r]:ends[r + 1]])


def fit_order(docs: DataFrame, k: int, sample_docs: int = SAMPLE_DOCS) -> TokenOrder:
    """Word frequencies and common shingles of about ``sample_docs`` documents,
    chosen by hash. Bounded by the sample, not by the corpus."""
    n = docs.count()
    share = min(1.0, sample_docs / max(n, 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000)).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.zeros(1 << 16, np.int64)
        for b in batches:
            for at, data, off in pieces(b.column(0), PIECE):
                words, first = word_hashes(data, off)
                level += np.bincount((words & U(0xFFFF)).astype(np.int64), minlength=1 << 16)
                h, _, row = shingle_hashes(words, first, k)
                ends = np.searchsorted(row, np.arange(len(off)))
                once = np.concatenate([np.unique(h[ends[r]:ends[r + 1]]) for r in range(len(off) - 1)])
                yield pa.record_batch([pa.array(np.ones(len(once), np.int32)), pa.array(once.view(np.int64)),
                                       pa.array(np.ones(len(once), np.int64))], names=["kind", "id", "n"])
        used = np.flatnonzero(level)
        yield pa.record_batch([pa.array(np.zeros(len(used), np.int32)), pa.array(used), pa.array(level[used])],
                              names=["kind", "id", "n"])

    counts = sample.mapInArrow(count, "kind int, id long, n long").groupBy("kind", "id").agg(F.sum("n").alias("n"))
    got = counts.where("kind = 0 OR n >= 3").toPandas()
    words, common = got[got.kind == 0], got[got.kind == 1]
    level = np.zeros(1 << 16, np.int64)
    level[words.id.to_numpy(np.int64)] = words.n.to_numpy(np.int64)
    return TokenOrder(np.minimum(np.log2(level + 1), 15).astype(np.uint8), np.sort(common.id.to_numpy(np.int64).view(np.uint64)), k)


POINTS = ("place_file string, place_row long, doc_id long, n long, sig1 long, sig2 long, point binary, routes array<long>")


def route_keys(ids: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set, of which any two linked sets share one: its first pairs of
    neighbours in the order, the last token's neighbour being the end. Of ``x``
    a token that ``y`` lacks breaks two pairs, one that only ``y`` has breaks
    one, so with t above a half at most ``2 (1-t) |x|`` pairs of x are not pairs
    of y, and the first shared pair is among the first of both. With lower t,
    single tokens."""
    n = len(ids)
    if 2 * num <= den:
        return mix(ids[:n - (num * n + den - 1) // den + 1])
    first = 2 * (den - num) * n // den + 1
    return mix(mix(ids[:first]) + np.append(ids[1:], U(2 ** 64 - 1))[:first])


def point_maker(order: TokenOrder, num: int, den: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            out = ([], [], [], [], [])
            if len(seen) > SEEN:
                seen.clear()
            for _, ids in order.sets(b.column("text")):
                n = len(ids)
                sig = int(mix(ids).sum()), int(mix(ids ^ U(0x5851F42D4C957F2D)).sum())
                routes = route_keys(ids, num, den).view(np.int64) if n and sig not in seen else np.zeros(0, np.int64)  # equal sets of some batches once
                seen.add(sig)
                out[0].append(n)
                out[1].append(sig[0] - (1 << 63))
                out[2].append(sig[1] - (1 << 63))
                out[3].append(packed(point(ids)))
                out[4].append(routes)
            at = np.cumsum([0, *map(len, out[4])]).astype(np.int32)
            routes = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(out[4]) if out[4] else np.zeros(0, np.int64)))
            yield pa.record_batch([b.column("place_file"), b.column("place_row"), b.column("doc_id"), pa.array(out[0], pa.int64()),
                                   pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                   pa.array(out[3], pa.binary()), routes],
                                  names=["place_file", "place_row", "doc_id", "n", "sig1", "sig2", "point", "routes"])
    return make


def set_maker(order: TokenOrder):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets, size = [], 0
            rest = b.drop_columns(["text"])
            at = 0
            for r, ids in order.sets(b.column("text")):
                sets.append(ids.tobytes())
                size += ids.nbytes
                if size > 8 << 20 or r == b.num_rows - 1:
                    yield pa.record_batch([*rest.slice(at, len(sets)).columns, pa.array(sets, pa.binary())],
                                          names=[*rest.schema.names, "payload"])
                    at, sets, size = r + 1, [], 0
    return make


def boxes(points: np.ndarray, sizes: np.ndarray, fan: int = 16):
    """Order of the points and the nodes of one R-tree level over them: first
    and last index, upper corner, smallest size. Points are packed by size,
    then by their counts."""
    order = np.lexsort((points[:, 1], points[:, 0], sizes))
    starts = np.arange(0, len(order), fan)
    return (order, starts, np.maximum.reduceat(points[order], starts, axis=0), np.minimum.reduceat(sizes[order], starts))


def near_pairs(pa_: np.ndarray, na: np.ndarray, pb: np.ndarray, nb: np.ndarray, num: int, den: int):
    """Index pairs (into a, into b) whose summed minima reach the bound; node
    pairs of the two R-trees are bounded first."""
    fan = 16
    oa, sa, ua, la = boxes(pa_, na, fan)
    ob, sb, ub, lb = boxes(pb, nb, fan)
    for i in range(len(sa)):
        top = np.minimum(ua[i], ub).sum(1)
        open_ = np.flatnonzero((den + num) * top >= num * (la[i] + lb))
        if not len(open_):
            continue
        ai = oa[sa[i]:sa[i] + fan]
        bj = np.concatenate([ob[sb[j]:sb[j] + fan] for j in open_])
        low = np.minimum(pa_[ai][:, None], pb[bj][None]).sum(2)
        x, y = np.nonzero((den + num) * low >= num * (na[ai][:, None] + nb[bj][None]))
        yield ai[x], bj[y]


def all_near_pairs(points: list, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int):
    """``near_pairs`` of the rows ``a`` with the rows ``b``, level by level of
    the number of groups: linked sizes are within a factor of two, so their
    numbers of groups are equal or adjacent."""
    width = np.array([len(p) for p in points])
    for g in sorted(set(width.tolist())):
        ia, ib = a[(width[a] == g) | (width[a] == 2 * g)], b[(width[b] == g) | (width[b] == 2 * g)]
        if not len(ia) or not len(ib):
            continue
        pa_, pb = (np.stack([folded(points[i], g) for i in i_]) for i_ in (ia, ib))
        for x, y in near_pairs(pa_, sizes[ia], pb, sizes[ib], num, den):
            mine = np.minimum(width[ia[x]], width[ib[y]]) == g
            yield ia[x[mine]], ib[y[mine]]


class Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def leaf_joiner(num: int, den: int, exact: bool):
    """Rows sorted by leaf pair -> for each pair of leaves a spanning forest, as
    edges to the roots, of its links: pairs within the bound, or, if ``exact``,
    verified on the sets."""

    def join(rows: list) -> list[tuple[int, int]]:
        side = np.array([r[0] for r in rows])
        nodes, sizes = [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)
        if exact:
            sets = [np.frombuffer(r[3], np.uint64) for r in rows]
            points = [point(s) for s in sets]
        else:
            points = [unpacked(r[3]) for r in rows]
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1)
        inside = not len(b)
        b = a if inside else b
        forest = Forest()
        for x, y in all_near_pairs(points, sizes, a, b, num, den):
            for i, j in zip(x.tolist(), y.tolist()):
                if (inside and i >= j) or nodes[i] == nodes[j] or forest.root(nodes[i]) == forest.root(nodes[j]):
                    continue
                if exact:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if den * both < num * (sizes[i] + sizes[j] - both):
                        continue
                forest.join(nodes[i], nodes[j])
        return [(x, forest.root(x)) for x in list(forest.up) if forest.root(x) != x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(9)]
            for root, band, kind, i, j, *row in zip(*cols):
                if (root, band, kind, i, j) != at:
                    if len(rows) > 1:
                        out += join(rows)
                    at, rows = (root, band, kind, i, j), []
                rows.append(row)
        if len(rows) > 1:
            out += join(rows)
        yield pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                              names=["a", "b"])

    return run


def split(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``points(root, node, n)`` of the subtrees that are one leaf, and of those that are cut; not those of one point."""
    sizes = points.groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    sizes = sizes.where("c > 1").withColumn("small", (F.col("c") <= LEAF) & (F.col("s") <= LEAF_TOKENS)).drop("c", "s")
    p = points.join(sizes, "root")
    return p.where("small").drop("small"), p.where("NOT small").drop("small")


def leaves_around(points: DataFrame, num: int, den: int) -> DataFrame:
    """``points(root, node, n, part)`` with the size band and its leaf in it
    (``sub``), and the numbers of leaves of either part, 0 or 1, in that band, the
    next and the one before (``own_0`` to ``prev_1``)."""
    step = 1.01 * math.log(den / num)
    p = points.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / step).cast("int"))
    leaves = p.groupBy("root", "band", "part").agg(F.ceil(F.greatest(F.count("*") / LEAF, F.sum("n") / LEAF_TOKENS)).cast("int").alias("k"))
    names = [f"{w}_{part}" for w in ("own", "next", "prev") for part in (0, 1)]
    at = F.expr("explode(map('own', band, 'next', band - 1, 'prev', band + 1))").alias("w", "near")
    around = (leaves.select("root", "part", "k", at).select("root", F.col("near").alias("band"), F.expr("concat(w, '_', part)").alias("w"), "k")
              .groupBy("root", "band").pivot("w", names).agg(F.first("k")))
    return p.join(around, ["root", "band"]).withColumn("sub", F.expr("cast(pmod(xxhash64(node), if(part = 0, own_0, own_1)) as int)"))


def _pair(band: str, kind: int, i: str, j: str, side: str) -> str:
    return f"named_struct('band', {band}, 'kind', {kind}, 'i', {i}, 'j', {j}, 'side', {side})"


def _with_each(leaves: str, pair: str) -> str:
    return f"if({leaves} is null, array(), transform(sequence(0, {leaves} - 1), x -> {pair}))"


def first_leaves(points: DataFrame, num: int, den: int) -> DataFrame:
    """``points(root, node, n)`` with their size band, their leaf in it and the leaves
    around (see ``leaves_around``); a subtree that is one leaf has no other."""
    small, big = split(points)
    big = leaves_around(big.withColumn("part", F.lit(0)), num, den)
    none = F.lit(None).cast("int")
    return small.select("root", "node", "n", F.lit(0).alias("band"), F.lit(0).alias("sub"), F.lit(1).alias("own_0"),
                        none.alias("next_0"), none.alias("prev_0")).unionByName(
        big.select("root", "node", "n", "band", "sub", "own_0", "next_0", "prev_0"))


def first_pairs(points: DataFrame) -> DataFrame:
    """``first_leaves`` and a payload, with ``pairs``, the leaf pairs (band, kind, i, j,
    side) that each point takes part in: every leaf with itself and with the first one of
    its band, first ones with those of the next band. All pairs of a subtree that
    is one leaf; else about four rows a point."""
    return points.select("root", "node", "n", "payload", F.expr(f"""concat(array({_pair('band', 0, 'sub', 'sub', '0')}),
            if(sub > 0, array({_pair('band', 0, '0', 'sub', '1')}), array()),
            if(sub = 0 AND own_0 > 1, transform(sequence(1, own_0 - 1), x -> {_pair('band', 0, '0', 'x', '0')}), array()),
            if(sub = 0 AND next_0 is not null, array({_pair('band', 1, '0', '0', '0')}), array()),
            if(sub = 0 AND prev_0 is not null, array({_pair('band - 1', 1, '0', '0', '1')}), array()))""").alias("pairs"))


def other_pairs(points: DataFrame) -> DataFrame:
    """``leaves_around`` and a payload, with ``pairs``, all leaf pairs whose sizes can match, but not those within part 1."""
    rest = ", ".join([_with_each("own_0", _pair("band", 0, "least(sub, x)", "greatest(sub, x)", "int(sub > x)")),
                      _with_each("next_0", _pair("band", 1, "sub", "x", "0")),
                      _with_each("prev_0", _pair("band - 1", 1, "x", "sub", "1")),
                      _with_each("own_1", _pair("band", 2, "x", "sub", "1")),
                      _with_each("prev_1", _pair("band - 1", 3, "x", "sub", "1")),
                      _with_each("next_1", _pair("band", 4, "sub", "x", "0"))])
    main = ", ".join([_with_each("own_0", _pair("band", 2, "sub", "x", "0")),
                      _with_each("next_0", _pair("band", 3, "sub", "x", "0")),
                      _with_each("prev_0", _pair("band - 1", 4, "x", "sub", "1"))])
    return points.select("root", "node", "n", "payload", F.expr(f"if(part = 0, concat({rest}), concat({main}))").alias("pairs"))


def join_leaves(points: DataFrame, num: int, den: int, exact: bool) -> DataFrame:
    """Edges among ``points(root, node, n, pairs, payload)``."""
    pair = ["root", "band", "kind", "i", "j"]
    each = points.select("root", "node", "n", "payload", F.explode("pairs").alias("p")).select("root", "p.*", "node", "n", "payload")
    return (each.repartition(*pair).sortWithinPartitions(*pair).select(*pair, "side", "node", "n", "payload")
            .mapInArrow(leaf_joiner(num, den, exact), "a long, b long"))


def linked(spark: SparkSession, points: DataFrame, payload: Callable[[DataFrame], DataFrame], num: int, den: int, exact: bool) -> DataFrame:
    """Components, as (node, root), of the links among ``points(root, node, n)``;
    ``payload`` adds the points or sets. The leaf pairs, as many as a subtree has leaves,
    are listed after that, on the executors: Spark counts an array as one element and
    would take a table that has them for small and send it over the driver. Subtrees of many leaves are joined twice:
    first in a few leaf pairs each, which makes one component of a group of near
    copies; then, where there are several, in all others except those within the
    subtree's largest component."""
    points = written(spark, points, "candidates")
    found = components(spark, join_leaves(first_pairs(payload(first_leaves(points, num, den))), num, den, exact))
    _, big = split(points)
    big = written(spark, big.join(merged(found.select("node", F.col("root").alias("part_of"))), "node", "left")
                  .select("root", "node", "n", F.coalesce("part_of", "node").alias("part_of")), "big")
    parts = big.groupBy("root", "part_of").agg(F.count("*").alias("c")).groupBy("root").agg(
        F.max(F.struct("c", "part_of"))["part_of"].alias("main"), F.count("*").alias("parts")).where("parts > 1")
    several = written(spark, big.join(parts, "root").select("root", "node", "n", (F.col("part_of") == F.col("main")).cast("int").alias("part")), "several")
    if several.isEmpty():
        return found
    more = join_leaves(other_pairs(payload(leaves_around(several, num, den))), num, den, exact)
    return components(spark, more.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def similar_sets(spark: SparkSession, docs: DataFrame, k: int, num: int, den: int, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: place_file, place_row (see ``with_place``), doc_id, n
    (distinct ``k``-word shingles), component_id, root (names the component;
    null for an empty set). Documents link where
    ``den * intersection >= num * union``."""
    small_batches(spark)
    placed = with_place(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    order = fit_order(docs.select("doc_id", "text"), k, sample_docs)
    points = placed.mapInArrow(point_maker(order, num, den), POINTS).withColumn("row", F.monotonically_increasing_id())
    points = written(spark, points, "sets")

    # routing: sets that share a routed token meet at the smallest of them
    meet = Window.partitionBy("token")
    routed = points.select("sig1", F.explode("routes").alias("token"))
    star = routed.withColumn("b", F.min("sig1").over(meet)).where("b != sig1").select(F.col("sig1").alias("a"), "b").distinct()
    subtree = components(spark, star)

    classes = (points.where("n > 0").groupBy("sig1", "sig2", "n").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id")))
    classes = written(spark, classes, "classes")
    cand = classes.join(subtree.withColumnRenamed("node", "sig1"), "sig1").select("root", "node", "n")
    own = points.select(F.col("row").alias("node"), F.col("point").alias("payload"))
    near = linked(spark, cand, lambda p: p.join(merged(own), "node"), num, den, False)

    def sets(p: DataFrame) -> DataFrame:
        kept = p.columns
        p = written(spark, p.join(merged(points.select(F.col("row").alias("node"), "place_file", "place_row")), "node"), "candidates")
        texts = placed.select("place_file", "place_row", "text").where(likely(spark, p, ["place_file", "place_row"]))
        return (texts.join(merged(p), ["place_file", "place_row"]).select(*kept, "text")
                .mapInArrow(set_maker(order), p.select(*kept).schema.add("payload", "binary")))

    left = near.join(merged(classes.select("node", "n")), "node").select("root", "node", "n")
    same = linked(spark, left, sets, num, den, True)

    root = classes.join(merged(same), "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = root.join(first, "root").select("sig1", "sig2", "n", "component_id", "root")
    own = points.select("place_file", "place_row", "doc_id", "n", "sig1", "sig2")
    return (own.where("n > 0").join(ids, ["sig1", "sig2", "n"]).select("place_file", "place_row", "doc_id", "n", "component_id", "root")
            .unionByName(own.where("n = 0").select("place_file", "place_row", "doc_id", "n", F.col("doc_id").alias("component_id"),
                                                   F.lit(None).cast("long").alias("root"))))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similar_sets(spark, table(spark, sf_dir, "documents"), 3, 90, 100)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], chr(1)))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, chr(1))] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.y) AS component_id
FROM w JOIN reach ON reach.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""
