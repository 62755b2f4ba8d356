"""Exact copies, similar sets, repeated bytes and repeated lines against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixture import ROWS
from pyspark.sql import functions as F

from tidepool.llm import exact_dedup, jaccard_join, line_dedup, repeated_bytes
from tidepool.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_dedup(spark, docs):
    got = sorted((r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                 for r in exact_dedup.exact_dedup(spark, docs, capacity=20_000).collect())
    groups = defaultdict(list)
    for d, t in ROWS:
        groups[t or ""].append(d)
    want = []
    for t, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = max(known, default=None)
        for j, d in enumerate(sorted(ids, key=lambda x: -1 if x is None else x, reverse=True)):
            want.append((d is None, d, keep, len(ids), j == 0, hashlib.sha256(t.encode()).hexdigest()))
    key = lambda x: (x[0], x[1] or 0, x[5], x[4])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(4000).selectExpr("xxhash64(id) AS h", "1000L AS bytes")
    buckets = exact_dedup.directory(keys, 50_000)
    assert len(buckets) > 64  # deeper than the first prefix sums
    assert sum(2.0 ** -d for d, _ in buckets) == 1.0  # the ranges cover all hashes once
    assert exact_dedup.directory(keys.limit(0), 10) == [(0, 0)]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_similar_sets(spark, docs, k, num, den):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n, -1 if r.component_id is None else r.component_id)
                 for r in jaccard_join.similar_sets(spark, docs, k, num, den).collect())
    sets = []
    for _, t in ROWS:
        w = WORD.findall((t or "").translate(SMALL))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(ROWS)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and den * both >= num * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(ROWS):
        least[root(i)].append(d)
    want = []
    for i, (d, _) in enumerate(ROWS):
        ids = [x for x in least[root(i)] if x is not None] if sets[i] else [d] if d is not None else []
        want.append((d is None, d or 0, len(sets[i]), min(ids, default=-1)))
    assert got == sorted(want)


def test_large_group_is_cut_into_leaves(spark, tmp_path, monkeypatch):
    """More near copies than a leaf holds, in several bands, come out as one
    component, and their links do not grow with the square of the group."""
    monkeypatch.setattr(jaccard_join, "LEAF", 8)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:300 - i % 20] + [f"x{i}"])) for i in range(60)] + [(100, "nothing like it at all")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = jaccard_join.similar_sets(spark, spark.read.parquet(str(tmp_path / "d")), 3, 90, 100).collect()
    assert {r.component_id for r in got if r.doc_id < 100} == {0}
    assert {r.component_id for r in got if r.doc_id == 100} == {100}


@pytest.mark.parametrize("num,den", [(80, 100), (90, 100), (51, 100), (40, 100)])
def test_linked_sets_share_a_route(num, den):
    rng = np.random.default_rng(1)
    linked = 0
    for n in [*range(1, 60), 300, 1000]:
        for _ in range(30):
            drawn = np.unique(rng.integers(0, 2 ** 40, 3 * n, dtype=np.uint64))
            rng.shuffle(drawn)
            out = int(rng.integers(0, int((1 - num / den) * n) + 1))
            more = int(((n - out) * den / num - n) + 1e-9)
            a, b = np.sort(drawn[:n]), np.sort(np.concatenate([drawn[out:n], drawn[n:n + max(0, more)]]))
            both = len(np.intersect1d(a, b))
            if both and den * both >= num * (len(a) + len(b) - both):
                linked += 1
                assert set(jaccard_join.route_keys(a, num, den).tolist()) & set(jaccard_join.route_keys(b, num, den).tolist())
    assert linked > 1000


def leaf_rows(spark, monkeypatch, docs, k, num, den, **kw):
    """The result, and how many rows of leaf pairs the points and the sets made."""
    seen, real = [], jaccard_join.join_leaves

    def counted(points, *args):
        seen.append(points.agg(F.sum(F.size("pairs"))).first()[0] or 0)
        return real(points, *args)
    monkeypatch.setattr(jaccard_join, "join_leaves", counted)
    return jaccard_join.similar_sets(spark, docs, k, num, den, **kw).collect(), sum(seen)


def test_texts_that_share_single_shingles_are_not_one_group(spark, tmp_path, monkeypatch):
    """Every text shares shingles with many others, none is like another: that
    must not put all of them into one subtree, whose leaves meet pairwise."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(jaccard_join, "LEAF", 8)
    parts = [" ".join(f"p{i}x{j}" for j in range(5)) for i in range(480)]
    deal = np.concatenate([rng.permutation(480) for _ in range(4)])  # each part in about four of 160 texts
    rows = [(d, " ".join(f"{parts[p]} u{d}y{p}" for p in deal[12 * d:12 * d + 12])) for d in range(160)]
    rows += [(1000, rows[7][1] + " and one more")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got, made = leaf_rows(spark, monkeypatch, spark.read.parquet(str(tmp_path / "d")), 5, 80, 100, sample_docs=1)
    assert {r.doc_id: r.component_id for r in got} == {**{d: d for d in range(160)}, 1000: 7}
    assert made < 160


def test_near_copies_are_not_joined_leaf_by_leaf(spark, tmp_path, monkeypatch):
    """A group of many leaves is one component after a few leaf pairs each; texts
    that meet it without being like it, or like only some of it, are still compared."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(jaccard_join, "LEAF", 8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(200):
        words = list(base)
        words[int(rng.integers(0, 200))] = f"x{d}"
        rows.append((d, " ".join(words[:200 - d % 3])))
    far = base[:150] + [f"far{i}" for i in range(50)]  # under 0.8 to all, but one step from each other
    rows += [(1000 + d, " ".join(far[:-1] + [f"z{d}"])) for d in range(20)]
    rows += [(2000, " ".join(base[:180] + [f"far{i}" for i in range(2)] + [f"q{i}" for i in range(8)]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got, made = leaf_rows(spark, monkeypatch, spark.read.parquet(str(tmp_path / "d")), 5, 80, 100)
    ids = {r.doc_id: r.component_id for r in got}
    assert {ids[d] for d in range(200)} == {0} and {ids[1000 + d] for d in range(20)} == {1000} and ids[2000] == 0
    assert made < 2 * 221 * 9  # 28 leaves; every leaf with every other one: 221 * 28 on points, as many on sets


def test_points_and_leaf_pairs_are_not_sent_over_the_driver(spark, tmp_path, monkeypatch):
    """A group of many leaves whose rows Spark takes for small: neither they nor
    their leaf pairs, which grow with the square of the group, are broadcast."""
    monkeypatch.setattr(jaccard_join, "LEAF", 8)
    base = [f"w{i}" for i in range(120)]
    rows = [(d, " ".join([*base[:119 - d % 3], f"x{d}"])) for d in range(120)]
    far = base[:90] + [f"far{i}" for i in range(30)]
    rows += [(1000 + d, " ".join(far[:-1] + [f"z{d}"])) for d in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    joined, real = [], jaccard_join.join_leaves

    def noted(points, *args):
        plan = points._jdf.queryExecution().executedPlan().toString()
        joined.append(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin) \[(node|place_file)#", plan)))
        return real(points, *args)
    monkeypatch.setattr(jaccard_join, "join_leaves", noted)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_sets(spark, spark.read.parquet(str(tmp_path / "d")), 5, 80, 100).collect()}
    assert {got[d] for d in range(120)} == {0} and {got[1000 + d] for d in range(20)} == {1000}
    assert len(joined) > 2 and set().union(*joined) == {("SortMergeJoin", "node"), ("SortMergeJoin", "place_file")}


def test_bound_never_prunes_a_link():
    rng = np.random.default_rng(0)
    for n in (5, 40, 700, 3000):
        a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        b = np.concatenate([a[: int(n * 0.95) or 1], np.unique(rng.integers(0, 2 ** 63, max(1, n // 40), dtype=np.uint64))])
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * both >= 90 * union:
            pts, sizes = [jaccard_join.point(a), jaccard_join.point(b)], np.array([len(a), len(b)])
            pairs = [p for x, y in jaccard_join.all_near_pairs(pts, sizes, np.array([0]), np.array([1]), 90, 100) for p in zip(x, y)]
            assert pairs == [(0, 1)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 60), (60, 100), (70, 70), (5, 200)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 200: 1, 60: 60, 100: 60}


def test_repeated_bytes(spark, docs):
    length = 200
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept_text))
                  for r in repeated_bytes.remove_repeated(spark, docs, length).collect())
    data = [(d, (t or "").encode()) for d, t in ROWS]
    seen = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    want = Counter()
    for d, b in data:
        gone = bytearray(len(b))
        end = 0
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[max(end, i):i + length] = b"\1" * (i + length - max(end, i))
                end = i + length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want[d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept] += 1
    assert got == want


def test_large_seed_groups_are_split(spark, tmp_path, monkeypatch):
    """A passage in all documents, with surroundings that differ, partly agree
    or agree at the text's edge: no collection is above the bound."""
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    passage, before, after = word(90), [word(140) for _ in range(3)], [word(140) for _ in range(3)]
    texts = [f"{word(150)}{passage}{word(150)}" for _ in range(12)]
    texts += [f"{word(30)}{before[i % 3][-(20 + 9 * i % 120):]}{passage}{after[i // 3 % 3][:130 - 7 * i % 120]}{word(30)}" for i in range(24)]
    texts += [passage + after[0], passage + after[0][:115] + "x", before[0] + passage, "y" + before[0][30:] + passage]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    sizes, split = [], repeated_bytes.split_groups

    def noted(*args):
        groups, whole = split(*args)
        sizes.extend(r["count"] for r in groups.groupBy("seed").count().collect())
        return groups, whole

    monkeypatch.setattr(repeated_bytes, "CONTEXTS", 4)
    monkeypatch.setattr(repeated_bytes, "split_groups", noted)
    got = {r.doc_id: bytes(r.kept_text).decode() for r in repeated_bytes.remove_repeated(spark, spark.read.parquet(str(tmp_path / "d"))).collect()}
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    for d, t in enumerate(texts):
        gone = {j for i in range(len(t) - 199) if seen[t[i:i + 200]] > 1 for j in range(i, i + 200)}
        assert got[d] == "".join(c for j, c in enumerate(t) if j not in gone)
    assert sizes and max(sizes) <= 4 and sum(map(len, got.values())) < sum(map(len, texts))


def test_inserted_columns_find_every_repeat():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, (60, 40)).astype(np.uint8)
    group = rng.integers(0, 4, 60)
    first, last = repeated_bytes.insert_columns(text, group, 6)
    for i in range(60):
        at = [p for p in range(35) if any(j != i and group[j] == group[i] and (text[j, p:p + 6] == text[i, p:p + 6]).all() for j in range(60))]
        assert (first[i], last[i]) == (min(at), max(at)) if at else last[i] == -1


def test_repeated_lines(spark, docs):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, tuple(r.removed)) for r in line_dedup.repeated_lines(spark, docs).collect())
    order = sorted(((d is None, d or 0, i) for i, (d, _) in enumerate(ROWS)))
    lines = []
    for _, _, i in order:
        lines += [(i, k, tuple(line_dedup.line_words(x))) for k, x in enumerate(ROWS[i][1].split("\n") if ROWS[i][1] else [])]
    gone, first = defaultdict(list), {}
    for pos, (i, k, w) in enumerate(lines):
        if w and w not in first:
            near = len(w) >= 5 and any(len(x) >= 5 and line_dedup.within_one(list(w), list(x)) for x in first)
            first[w] = (pos, near)
        if w and (first[w][0] != pos or first[w][1]):
            gone[i].append(k)
    # repeated rows may take each other's place
    want = sorted((d is None, d or 0, len(t.split("\n")) if t else 0, tuple(gone[i])) for i, (d, t) in enumerate(ROWS))
    assert got == want


def test_without_lines(spark):
    df = spark.createDataFrame([("a\nb\nc", [1]), ("x", [0]), ("p\n\n", [])], "text string, removed array<int>")
    assert [r[0] for r in df.select(line_dedup.without_lines(df.text, df.removed)).collect()] == ["a\nc", "", "p\n\n"]


def test_empty_tables(spark, no_docs):
    assert exact_dedup.exact_dedup(spark, no_docs).count() == 0
    assert jaccard_join.similar_sets(spark, no_docs, 5, 80, 100).count() == 0
    assert repeated_bytes.remove_repeated(spark, no_docs).count() == 0
    assert line_dedup.repeated_lines(spark, no_docs).count() == 0


def test_texts_come_to_python_a_few_mb_at_a_time(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes]), pa.array([b.num_rows])], names=["bytes", "n"])

    docs = spark.range(0, 9000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 400) AS text")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        jaccard_join.similar_sets(spark, docs.limit(3), 5, 80, 100)
        got = docs.mapInArrow(sizes, "bytes long, n long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert sum(r.n for r in got) == 9000 and max(r.bytes for r in got) < 5 << 20


def test_equal_sets_of_a_task_are_routed_once_over_batches_and_long_texts():
    import pyarrow as pa

    order = jaccard_join.TokenOrder(np.zeros(1 << 16, np.uint8), np.zeros(0, np.uint64), 5)
    texts = [" ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(200_000)), "", None]
    batch = pa.record_batch([pa.array(["f"] * 4), pa.array(range(4), pa.int64()), pa.array(range(4), pa.int64()), pa.array(texts)],
                            names=["place_file", "place_row", "doc_id", "text"])
    first, again = jaccard_join.point_maker(order, 80, 100)(iter([batch, batch]))
    assert first.column("n").to_pylist() == again.column("n").to_pylist() == [36, 199_996, 0, 0]
    assert [len(r) > 0 for r in first.column("routes").to_pylist()] == [True, True, False, False]
    assert [len(r) for r in again.column("routes").to_pylist()] == [0, 0, 0, 0]
    assert first.column("sig1").to_pylist() == again.column("sig1").to_pylist()
