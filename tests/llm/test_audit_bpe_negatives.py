"""Filter audit, BPE and hard negatives against brute force."""

import random
from collections import Counter, defaultdict
from itertools import permutations, product

import numpy as np
import pytest
from llm_fixture import ROWS, SCHEMA, WORDS
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import bpe, filter_audit, hard_negatives

PATH = "/opt/tokenizers/word_bpe_49k.json"


# --- filter audit ---------------------------------------------------------------------
def brute_audit(rows, filters):
    """rows: (part, set of failed letters, good, toxic)."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations(filters):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for order in permutations(filters):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return out


def rows_of(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_intervals_are_one_step_per_order_and_mask():
    orders = list(permutations(range(4)))
    steps = defaultdict(list)
    for mask, step, first, after in filter_audit.rank_intervals(4):
        for rank in range(first, after):
            steps[mask, rank].append(step)
    for mask, rank in product(range(1, 16), range(24)):
        want = min(k for k, f in enumerate(orders[rank], 1) if mask >> f & 1)
        assert steps[mask, rank] == [want]
    assert len(filter_audit.rank_intervals(5)) == 840


@pytest.mark.parametrize("filters", ["A", "XYZ", "ABCDE"])
def test_audit(spark, filters):
    r = random.Random(3)
    rows = []
    for i in range(300):
        mask = r.randrange(1 << len(filters)) if r.random() < 0.7 else 0
        rows.append((r.choice(["p", "q", "", None, "p"]), mask, r.random() < 0.5, None if i % 3 else True))
    df = spark.createDataFrame(rows + [("only", None, None, None)], "part string, mask int, good boolean, toxic boolean")
    want = brute_audit([(p or "", {f for i, f in enumerate(filters) if m >> i & 1}, bool(g), bool(t)) for p, m, g, t in rows]
                       + [("only", set(), False, False)], filters)
    assert rows_of(filter_audit.audit(spark, df, filters)) == want


def test_filter_masks(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (60, 1, 1)], "doc_id long, quality int, toxic int")
    got = Counter((r.part, r["mask"], bool(r.good), bool(r.toxic)) for r in filter_audit.filter_masks(spark, docs, labels).collect())
    import re
    first = {}
    for d, t in ROWS:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    want = Counter()
    for d, t in ROWS:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        mask = (len(w) < 200) + 2 * (100 * len(set(w)) < 50 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        mask += 8 * bool(re.search(r"[#$%&*|]", t)) + 16 * (d is not None and first[t] < d)
        want["s", mask, d in (1, 60), d in (1, 60)] += 1
    assert got == want
    assert filter_audit.audit(spark, filter_audit.filter_masks(spark, no_docs, labels)).count() == 0


# --- BPE ------------------------------------------------------------------------------
TEXTS = [
    "", "   \n\t", "Hello, World! it's 2024's ’s 'S 'll", "a" * 5000, "ΑΣ Σ ΣΑΣ", "İstanbul ıI", "naïve café Å", "日本語テキスト 漢字", "🙂🙃 ok",
    "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|endoftext|", "a b c\x1cd\x85e", "١٢٣ Ⅷ ½", "ᲉꟋ \U00010940", "tab\tnew\nline", "!!!???...", "'", "don't'll've",
    "ab " * 3000, "\x00\x01", "ﬁ ﬂ", "é" * 50, "-" * 300,
]


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(PATH)


def encoded(encoder, texts):
    out = [[] for _ in texts]
    for i, run in encoder.encode(texts):
        out[i] += run.tolist()
    return out


@pytest.mark.parametrize("frequent", [0, 100])
def test_encoder_equals_library(library, frequent):
    v = bpe.Vocabulary.read(PATH)
    texts = TEXTS + [t or "" for _, t in ROWS]
    words = Counter(w for t in texts for p in v.split.pieces(t) if not isinstance(p, int) for c in p for w in v.split.words(c))
    lexicon = bpe.Lexicon.build({w.encode(): v.merged(w.encode()) for w, _ in words.most_common(frequent)})
    got = encoded(bpe.Encoder(v, lexicon), texts)
    for text, ids in zip(texts, got):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:80]
        assert v.decoded(ids) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("held, piece", [(1 << 18, 1 << 20), (40, 64)])
def test_digests_are_of_the_encoded_ids(monkeypatch, held, piece):
    """Hashed chunk by chunk, each chunk's bytes made once; also when chunks are forgotten and texts come in pieces."""
    import hashlib

    v = bpe.Vocabulary.read(PATH)
    texts = [*TEXTS, *[t or "" for _, t in ROWS], *TEXTS]
    ids = encoded(bpe.Encoder(v, bpe.Lexicon.build({})), texts)
    want = [(len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(v.decoded(x).encode()).hexdigest()) for x in ids]
    monkeypatch.setattr(bpe, "HELD", held)
    monkeypatch.setattr(bpe, "PIECE", piece)
    encoder, calls = bpe.Encoder(v, bpe.Lexicon.build({})), []
    lists = encoder.lists
    monkeypatch.setattr(encoder, "lists", lambda chunks: calls.append(len(chunks)) or lists(chunks))
    assert encoder.digests(texts) == want
    if piece > 64:
        assert calls == [len({c for t in texts for p in v.split.pieces(t) if not isinstance(p, int) for c in p})]


def test_encoder_equals_library_on_random_texts(library):
    r = random.Random(1)
    signs = "abcdefgh ABCDé'’sStTm.,!?0123456789\n\t ΣÅ漢🙂-_#<|>" + "́Ᲊ"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 120))) for _ in range(800)]
    v = bpe.Vocabulary.read(PATH)
    got = encoded(bpe.Encoder(v, bpe.Lexicon.build({})), texts)
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_heap_and_list_merge_alike():
    v, r = bpe.Vocabulary.read(PATH), random.Random(2)
    for _ in range(300):
        word = "".join(r.choice(["th", "e", "in", "g", "er", "aa", "a", "x"]) for _ in range(r.randint(1, 12))).encode()[:bpe.SHORT]
        ids = [v.starts[b] for b in word]
        ids[-1] = v.ends[word[-1]]
        assert v.merged(word) == v._merged_by_heap(ids)


def test_lexicon_is_minimal_and_exact():
    r = random.Random(4)
    words = {"".join(r.choice(WORDS) for _ in range(r.randint(1, 3))).encode(): [i, 2 * i] for i in range(800)}
    words |= {b"a": [1], b"ab": [2], b"abc": []}
    lexicon = bpe.Lexicon.build(words)
    order = sorted(words)
    asked = [*order, b"", b"zz", order[5] + b"x", order[7][:-1]]
    want = [order.index(w) if w in words else -1 for w in asked]
    assert lexicon.places(asked).tolist() == want
    assert all(lexicon.ids[lexicon.starts[i]:lexicon.starts[i + 1]].tolist() == words[w] for i, w in enumerate(order))
    # minimal: no two states have the same words below them
    below = defaultdict(set)
    for w in order:
        for i in range(len(w) + 1):
            below[w[:i]].add(w[i:])
    assert len(lexicon.final) == len({frozenset(x) for x in below.values()})
    # the file has the same parts
    assert bpe.Lexicon.build({}).places([b"a"]).tolist() == [-1]


def test_documents_through_spark(spark, docs, no_docs, library):
    import hashlib
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(spark, docs, PATH, 500).collect())
    want = []
    for d, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((d is None, d or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    coded = bpe.encode_documents(spark, docs, PATH, 500)
    texts = sorted((r.doc_id or -1, r.decoded) for r in coded.select("doc_id", "decoded").collect())
    assert texts == sorted((r.doc_id or -1, r.decoded) for r in bpe.decode_documents(spark, coded, PATH).collect())
    assert bpe.digests(spark, no_docs, PATH).count() == 0


# --- hard negatives -------------------------------------------------------------------
def brute_negatives(rows, every, positives=5, negatives=3, low=50, high=95):
    table = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        q = [int(np.floor(256 * float(c))) for c in x]
        key = (label, b"".join(int(c).to_bytes(4, "little", signed=True) for c in q))
        if i not in table or key < table[i][0]:
            table[i] = (key, label, q)
    score = lambda a, b: sum(x * y for x, y in zip(table[a][2], table[b][2]))
    out = []
    for a in table:
        if a % every:
            continue
        same = sorted((-score(a, b), b) for b in table if b != a and table[b][1] == table[a][1])[:positives]
        for s, p in same:
            other = sorted((-score(a, b), b) for b in table if table[b][1] != table[a][1] and low * -s <= 100 * score(a, b) <= high * -s)[:negatives]
            out += [(a, p, r, b, -s, -t) for r, (t, b) in enumerate(other, 1)]
    return sorted(out)


def vectors(n, d, seed):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(6, d))
    rows = []
    for i in range(n):
        label = int(r.integers(4))
        rows.append((i, label, [float(c) for c in (middle[label] + 0.8 * r.normal(size=d)) / 4]))
    same = rows[3][2]
    rows += [(n + i, i % 3, same) for i in range(n // 3)]  # a hot vector
    rows += [(5, None, same), (6, 2, None), (None, 1, same), (9001, 1, [1.0, None, 2.0]), (9002, 2, [float("nan")] * d), (9003, 1, [float("inf")] * d),
             (9004, 1, []), (9005, 2, [0.0] * d), (9006, 3, same[:3]), (9010, 1, same[:2]), rows[0], rows[10], (20, 1, same), (9020, 0, [-c for c in same])]
    return rows


SHAPE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                      T.StructField("block", T.StringType()), T.StructField("q", T.StringType()), T.StructField("group", T.LongType())])


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:  # many blocks, groups, clusters and stretches
        for name, value in {"SMALL_BLOCK": 16, "CHUNK": 4, "CHUNKS": 2, "MEMBERS": 3, "STEP": 8}.items():
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(240, 6, 1)
    df = spark.createDataFrame([(*r, "b", "q", 1) for r in rows], SHAPE)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(spark, df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_negatives(rows, 10)


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], SHAPE)
    assert hard_negatives.hard_negatives(spark, none, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0], "b", "q", 1)], SHAPE)
    assert hard_negatives.hard_negatives(spark, one, F.col("vec_id") % 10 == 0).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    big = [float(2 ** 17) + i for i in range(8)]  # scores over 2^53
    rows = [(10 * i, i % 2, [c * (1 - 0.05 * i) for c in big]) for i in range(8)]
    df = spark.createDataFrame([(*r, "b", "q", 1) for r in rows], SHAPE)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(spark, df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_negatives(rows, 10)


def test_walk_ends_before_the_list_does():
    r = np.random.default_rng(0)
    near, far = r.normal(size=8), r.normal(size=8)
    far -= near * (near @ far) / (near @ near)
    x = np.round(np.concatenate([near + 0.01 * r.normal(size=(50, 8)), far + 0.01 * r.normal(size=(5000, 8))]) * 1000)
    import pyarrow as pa
    cell = hard_negatives.Cell(pa.table({"vec_id": np.arange(len(x)), "label": np.zeros(len(x), np.int64), "q": [v.astype("<i4").tobytes() for v in x]}))
    best, seen = hard_negatives.Best(4, 5), []

    def look(rows, scores, some):
        seen.append(len(some))
        best.add(rows, scores, np.ones(scores.shape, bool), cell.id[some])

    members = x[:4]
    cell.walk(members, lambda rows: best.score[rows, -1].astype(float), look)
    assert sum(seen) < 1100
    for i in range(4):
        s = (x @ members[i]).astype(np.int64)
        assert best.id[i].tolist() == sorted(range(len(x)), key=lambda j: (-s[j], j))[:5]
