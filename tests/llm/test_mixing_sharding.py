"""Mixing rates, sharding, and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from llm_fixture import ROWS
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import jaccard_join, mixing, sharding
from tidepool.llm.common import with_place


def test_rates_match_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet((0.3, 0.2, 0.2), 400)
    n = rng.integers(1, 900, 400)
    post = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(400)], "id long, n_tokens long, p_high double, p_low double, p_toxic double")
    weights = {"high": 0.9, "low": 0.08, "toxic": 0.02}
    got = mixing.solve_rates(spark, post, weights).orderBy("id").toPandas()
    rate = got.rate.to_numpy()
    totals = (n[:, None] * p * rate[:, None]).sum(0)
    share = (n[:, None] * p).sum(0)
    target = share[0] * np.array([0.9, 0.08, 0.02]) / 0.9
    assert (rate >= 0).all() and np.allclose(totals, target, rtol=0.02)
    # no other nonnegative rates with these totals are needed: a plain numpy descent gets to the same totals
    x = np.ones(400)
    for _ in range(60_000):
        x = np.maximum(0, x - p @ (((n[:, None] * p * x[:, None]).sum(0) - target) / share))
    assert np.allclose((n[:, None] * p * x[:, None]).sum(0), totals, rtol=0.02)


def test_default_targets_remove_low_and_toxic(spark):
    """Domains with the shares of the corpus: low and toxic go, the anchor stays."""
    rng = np.random.default_rng(7)
    top = rng.choice(3, 2000, p=(0.87, 0.065, 0.065))
    p = np.full((2000, 3), 1e-4)
    p[np.arange(2000), top] = 1 - 2e-4
    rows = [(i, int(rng.integers(100, 900)), *map(float, p[i])) for i in range(2000)]
    post = spark.createDataFrame(rows, "id long, n_tokens long, p_high double, p_low double, p_toxic double")
    rate = mixing.solve_rates(spark, post).orderBy("id").toPandas().rate.to_numpy()
    assert rate[top == 0].min() > 0.98 and rate[top == 0].max() < 1.02
    assert rate[top == 1].max() < 0.2 and rate[top == 2].max() < 0.01


def test_mixing_of_documents(spark, docs, no_docs):
    labels = docs.where("doc_id < 30").select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"), (F.col("doc_id") % 7 == 0).cast("int").alias("toxic"))
    out = mixing.mixed(spark, docs, labels.unionByName(labels.limit(3))).collect()
    assert len(out) == len(ROWS)
    for r in out:
        assert r.rate >= 0 and abs(r.p_high + r.p_low + r.p_toxic - 1) < 1e-9 and r.copies in (int(r.rate), int(r.rate) + 1)
    assert {r.rate for r in mixing.mixed(spark, docs, labels.limit(0)).collect()} == {1.0}
    assert mixing.mixed(spark, no_docs, labels).count() == 0


def check_shards(rows, texts, n_shards):
    at = defaultdict(set)
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        at[r.text_crc32, r.size].add(r.shard)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in at.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter((r.size, r.text_crc32) for r in rows) == Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert set(at) and set().union(*at.values()) <= set(range(n_shards))
    return load


def test_sharding(spark, docs, no_docs, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    rows = sharding.shard_documents(spark, docs, 4).collect()
    load = check_shards(rows, [t for _, t in ROWS], 4)
    assert max(load.values()) - min(load.values()) <= max(Counter((r.size, r.text_crc32) for r in rows).items(), key=lambda x: x[0][0] * x[1])[0][0] * 6
    assert sharding.shard_documents(spark, no_docs).count() == 0


def test_bundled_shards_are_nearly_equal(spark):
    sized = spark.range(60_000).select(F.col("id").cast("string").alias("group_key"), (F.pmod(F.xxhash64("id"), F.lit(1000)) + 1).alias("size"))
    out = sharding.assign_shards(spark, sized, 16, grain=4, bundles=64, levels=5)
    loads = [r[1] for r in out.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(loads) == 16 and (max(loads) - min(loads)) / max(loads) < 0.01


def test_longest_first():
    got = sharding.longest_first([(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")], 2)
    assert [got[x] for x in "abcde"] == [0, 1, 1, 0, 0]


def test_places_come_from_files(spark, docs):
    rows = with_place(docs.select("doc_id")).collect()
    assert len({(r.place_file, r.place_row) for r in rows}) == len(ROWS) and all(r.place_file for r in rows)


def test_pipeline(spark, docs, tmp_path):
    sf = str(tmp_path)
    leak = ROWS[3][1].split("\n")[0]
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs.where("doc_id < 30").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{sf}/labels.parquet")
    d, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, sf).write.parquet(f"{sf}/{i}")
        was, d = d, spark.read.parquet(f"{sf}/{i}")
        kept[name] = [r.doc_id for r in d.collect()]
        if name != "sharding":
            assert d.columns == was.columns
    assert {60, 61, 62, 63} & set(kept["language_id"]) == set() and {0, 64, 67} <= set(kept["language_id"])
    # one document of each component of the stage's input
    groups = defaultdict(list)
    for r in jaccard_join.similar_sets(spark, spark.read.parquet(f"{sf}/0"), 5, 80, 100).collect():
        groups[r.root].append(r.doc_id)
    assert Counter(kept["near_duplicates"]) == Counter(min((x for x in g if x is not None), default=None) for g in groups.values())
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {3}
    assert Counter(kept["mixing"]) == Counter(kept["decontamination"])  # one domain: nothing to mix
    check_shards(d.collect(), [r.text for r in spark.read.parquet(f"{sf}/3").collect()], 16)


def test_pipeline_of_an_empty_table(spark, no_docs, tmp_path):
    sf = str(tmp_path)
    no_docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "x y z")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_two_results_are_built_before_either_is_read(spark, docs, tmp_path):
    import os

    from tidepool.llm.common import shared_dir

    sf = str(tmp_path)
    docs.where("doc_id < 20").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "x y z")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    before = set(os.listdir(f"{shared_dir(spark)}/llm"))
    first, second = corpus_pipeline.run(spark, sf), corpus_pipeline.run(spark, sf)
    assert first.count() == second.count() == 20
    left = [n for n in os.listdir(f"{shared_dir(spark)}/llm") if n not in before and n.startswith("stage-")]
    assert len(left) == 2  # each run keeps the input of its last stage only
