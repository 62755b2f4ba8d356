"""Whole results against independent re-computations: contamination, posteriors, shards."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
import regex
from llm_fixture import ROWS
from pyspark.sql import functions as F

from tidepool.llm import decontamination as D
from tidepool.llm import mixing, sharding


# --- decontamination: both readings, windows and alignments in plain Python -------------------
def tokens(text):
    t = (text or "").translate({1: " ", 2: " "})
    t = regex.sub(r"(?i)([0-9][\s\p{Z}]+)(?=(?:" + "|".join(D.UNITS) + r")\b)", "\\1\x02", t)
    t = regex.sub(r"([\p{L}\p{N},;][\s\p{Z}]+)(?=\p{Lu}\p{Ll})", "\\1\x01", t)
    return [w for w in regex.split(r"[^\p{L}\p{N}\x01\x02]+", t.lower()) if w]


def kind(w):
    return D.NAME if w[0] == "\x01" else D.UNIT if w[0] == "\x02" else D.NUMBER if "0" <= w[0] <= "9" else None


def form(words):
    return tuple(kind(w) or w for w in words)


def named(words):
    return any(w[0] == "\x01" for w in words)


def readings(marked):
    return {False: [w.replace("\x01", "") for w in marked], True: marked}


def brute_contaminated(docs, items):
    index, n_windows = defaultdict(list), {}
    for item, text in items:
        marked = tokens(text)
        w = min(len(marked), D.WINDOW)
        if w < D.MIN_TOKENS:
            continue
        every, typed_ones = set(), set()
        for typed, words in readings(marked).items():
            for at in range(len(words) - w + 1):
                has, part = named(marked[at:at + w]), words[at:at + w]
                if 2 * sum(kind(x) is None for x in part) >= w and (not typed or has):
                    index[w, typed, form(part)].append((item, at, part, has))
                    every.add(at)
                    if typed or not has:
                        typed_ones.add(at)
        n_windows[item] = len(every), len(typed_ones)
    lengths = {w for w, _, _ in index}
    out = []
    for doc, text in docs:
        marked = tokens(text)
        aligned = defaultdict(lambda: (set(), set()))
        for typed, words in readings(marked).items():
            for w in lengths:
                for at in range(len(words) - w + 1):
                    has, part = named(marked[at:at + w]), words[at:at + w]
                    if typed and not has:
                        continue
                    for item, item_at, item_part, item_has in index.get((w, typed, form(part)), []):
                        for reading in [True] if typed else [False] if has or item_has else [False, True]:
                            slots, ats = aligned[item, reading, at - item_at]
                            slots.update((kind(a), a, b) for a, b in zip(part, item_part) if kind(a))
                            ats.add(item_at)
        got = defaultdict(lambda: (set(), set(), [0]))
        for (item, reading, _), (slots, ats) in aligned.items():
            if len(slots) == len({(k, a) for k, a, _ in slots}) == len({(k, b) for k, _, b in slots}):
                got[item][0].update(ats)
                got[item][1].update(ats if reading else ())
                got[item][2].append(len(slots))
        for item, (ats, typed_ats, sizes) in got.items():
            n, n_typed = n_windows[item]
            if len(ats) >= min(D.NEED, n) or n_typed and len(typed_ats) >= min(D.NEED, n_typed):
                out.append((doc, item, len(ats), n, max(sizes)))
    return Counter(out)


def test_contaminated_pairs_of_a_whole_table(spark, sf_small):
    docs, items = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    got = Counter((r.doc_id, r.item_id, r.matched_windows, r.item_windows, r.n_slots) for r in D.contaminated(spark, docs, items).collect())
    want = brute_contaminated([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got == want and got


NAMED = "If Anna walks 12 km each day for 3 days and then rests with Peter in Bern, how many km did Anna walk before the rest in Bern?"
VARIANTS = [NAMED, NAMED.replace("Anna", "Zoe").replace("12", "15"), NAMED.replace("12", "3"), NAMED.lower(), NAMED.upper(), NAMED.replace(" ", "\n"),
            NAMED.replace("Anna", "Bern"), "Some words before. " + NAMED[:70], NAMED.replace("Anna", "the girl"), None, "", "12 12 12 12 12", NAMED * 3]


def test_contamination_of_variants(spark):
    items = [(1, NAMED), (2, "a b c"), (3, "one two three four"), (4, "Add 5 and 6 and 7 and 8 to 9"), (5, None), (6, VARIANTS[3])]
    docs = [(i, t) for i, t in enumerate(VARIANTS)] + [(50, "one two three four five"), (51, "Add 1 and 2 and 3 and 4 to 5"), (None, NAMED)]
    got = D.contaminated(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter((r.doc_id, r.item_id, r.matched_windows, r.item_windows, r.n_slots) for r in got.collect()) == brute_contaminated(docs, items)


# --- mixing: posteriors of naive Bayes ---------------------------------------------------------
def test_posteriors(spark, docs):
    ids = sorted({d for d, _ in ROWS if d is not None})
    labels = spark.createDataFrame([(d, int(d % 3 != 0), int(d % 5 == 0)) for d in ids[:40]], "doc_id long, quality int, toxic int")
    domain = {d: "toxic" if d % 5 == 0 else "high" if d % 3 else "low" for d in ids[:40]}
    cut = str.maketrans({"\n": " ", "\t": " ", "\r": " ", **dict.fromkeys('.,;:!?|()"')})
    words = [[w for w in (t or "").lower().translate(cut).split(" ") if w] for _, t in ROWS]
    every = sorted({w for ws in words for w in ws})
    at = {r.w: r.b for r in spark.createDataFrame([(w,) for w in every], "w string").select("w", mixing.bucket(F.col("w")).alias("b")).collect()}
    counts = {k: Counter() for k in mixing.DOMAINS}
    for (d, _), ws in zip(ROWS, words):
        if d in domain:
            counts[domain[d]].update(at[w] for w in ws)
    seen = Counter(domain.values())
    want = []
    for ws in words:
        n = len(ws)
        score = {k: math.log(seen[k] / 40) + min(n, mixing.LONGEST) / max(n, 1) * sum(
            math.log((counts[k][at[w]] + 0.1) / (counts[k].total() + 0.1 * mixing.BUCKETS)) for w in ws) for k in mixing.DOMAINS}
        e = {k: math.exp(s - max(score.values())) for k, s in score.items()}
        want.append((n, *[e[k] / sum(e.values()) for k in mixing.DOMAINS]))
    got = sorted((r.n_tokens, r.p_high, r.p_low, r.p_toxic) for r in mixing.posteriors(spark, docs, labels).collect())
    for a, b in zip(got, sorted(want), strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=2e-3)


# --- sharding: largest first to the least loaded ---------------------------------------------------
@pytest.mark.parametrize("n_shards", [1, 3, 16])
def test_shards_are_those_of_largest_first(spark, docs, n_shards):
    sized = docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("group_key"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"))
    got = {r.group_key: r.shard for r in sharding.assign_shards(spark, sized, n_shards, grain=1 << 30).select("group_key", "shard").distinct().collect()}
    size = Counter()
    for _, t in ROWS:
        size[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    load, want = [0] * n_shards, {}
    for key in sorted(size, key=lambda k: (-size[k], str(("g", k)))):
        want[key] = load.index(min(load))
        load[want[key]] += size[key]
    assert got == want
