"""Mixing documents to target weights by soft domain membership.

The ``labels`` table names the domain of some documents: ``toxic``, else
``high`` or ``low`` by quality. A naive Bayes classifier on hashed words,
counted over a bounded sample of labelled documents (at most ``SAMPLE``, those
with the smallest hash of doc_id), gives every document its posterior over the
domains. With n the tokens, p the posteriors and x the rate of a document, the
expected tokens of domain d are ``sum n p_d x``. Rates start at 1 and follow
projected gradient descent on the squared misses of the targets under
``x >= 0``; with ``miss_d = sum n p_d x - target_d``,

    x <- max(0, x - step * sum_d p_d g_d),   H g = miss,   H_de = sum over x > 0 of n p_d p_e

H scales the gradient by the tokens that can still move (a domains x domains
matrix), so small domains and rates at zero do not slow it down; the step is
halved when a round gains too little. A round is one aggregation over the
posteriors that returns the misses and H; rates are a function of these
numbers, and are written every ``REWRITE`` rounds. The anchor domain's target
is its own share, the others follow from the weights. A rate above 1 means
copies; ``copies`` rounds it up or down by a hash of the document, so the
expectation is kept.

All of it is DataFrame functions. Texts are read once; words are summed per
document where they are read.

Defined results: null and empty texts have no tokens, the domains' prior as
posterior and are rated like any other; null doc_ids are never learned from;
repeated rows get equal rates; without two labelled domains every rate is 1; a
domain without expected tokens cannot be matched and is left out; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import table, with_place, written

DOMAINS = ("high", "low", "toxic")
# Clearly below the shares of low (6.2 %) and toxic (6.3 % of the tokens of
# sf0.1), so that their documents go and the anchor's stay.
WEIGHTS = {"high": 0.99, "low": 0.0095, "toxic": 0.0005}
ANCHOR = "high"
SAMPLE = 20_000
BUCKETS = 1 << 16
LONGEST = 500
ROUNDS, REWRITE, NEAR = 40, 6, 1e-4


def words(text: Column) -> Column:
    t = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\n\t\r.,;:!?|()\"", "   ")
    return F.array_remove(F.split(t, " "), "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id and domain, one row per labelled document."""
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    return one.select("doc_id", F.when(F.col("t") == 1, "toxic").when(F.col("q") == 1, "high").when(F.col("q") == 0, "low")
                      .alias("domain")).where("domain IS NOT NULL")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, float], dict[str, Column]]:
    """Prior of each domain, and its weights per bucket as an array column."""
    known = labelled(labels)
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded: the classifier's sample
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    counts = (texts.select("domain", F.explode(words(F.col("text"))).alias("word"))
              .groupBy("domain", bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n")))
    counts = written(spark, counts, "word-counts")
    total = {r.domain: r.n for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    seen = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    every = sum(seen.get(d, 0) for d in total) or 1
    prior = {d: seen.get(d, 0) / every for d in DOMAINS if total.get(d)}
    zero = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), *[F.lit(0).cast("long").alias(d) for d in DOMAINS])
    wide = counts.select("bucket", *[F.when(F.col("domain") == d, F.col("n")).otherwise(0).cast("long").alias(d) for d in DOMAINS])
    wide = wide.unionByName(zero).groupBy("bucket").agg(*[F.sum(d).alias(d) for d in DOMAINS])
    wide = written(spark, wide, "word-weights")

    def weight(d: str) -> Column:
        value = F.log((F.col(d) + 0.1) / (total[d] + 0.1 * BUCKETS)).cast("float")
        inorder = F.transform(F.array_sort(F.collect_list(F.struct("bucket", value.alias("w")))), lambda x: x["w"])
        return wide.agg(inorder.alias("w")).scalar()  # BUCKETS floats

    return prior, {d: weight(d) for d in prior}


def posteriors(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """place_file, place_row, doc_id, text_key, n_tokens and p_<domain> of every document."""
    prior, weights = fit(spark, docs, labels)
    d = with_place(docs.select("doc_id", "text")).select(
        F.monotonically_increasing_id().alias("id"), "place_file", "place_row", "doc_id", F.xxhash64("text").alias("text_key"),
        words(F.col("text")).alias("words"))
    d = d.select("id", "place_file", "place_row", "doc_id", "text_key", F.explode_outer("words").alias("word"))
    at = bucket(F.col("word")) + 1
    keys = ["id", "place_file", "place_row", "doc_id", "text_key"]
    sums = (d.select(*keys, F.col("word").isNotNull().cast("int").alias("one"),
                     *[F.when(F.col("word").isNotNull(), F.element_at(w, at)).otherwise(F.lit(0.0)).alias(k) for k, w in weights.items()])
            .groupBy(*keys).agg(F.sum("one").alias("n_tokens"), *[F.sum(F.col(k).cast("double")).alias(k) for k in weights]))
    n = F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")
    score = {k: F.log(F.lit(prior[k])) + F.col(k) * F.least(n, F.lit(float(LONGEST))) / n for k in weights}
    top = F.greatest(*score.values()) if len(score) > 1 else next(iter(score.values()), F.lit(0.0))
    raw = sums.select(*keys[1:], "n_tokens", *[F.exp(s - top).alias(k) for k, s in score.items()])
    whole = sum((F.col(k) for k in score), F.lit(0.0))
    return raw.select(*keys[1:], "n_tokens", *[(F.col(k) / whole if k in score else F.lit(0.0)).alias(f"p_{k}") for k in DOMAINS])


def solve_rates(spark: SparkSession, post: DataFrame, weights: dict[str, float] = WEIGHTS, anchor: str = ANCHOR) -> DataFrame:
    """Add ``rate`` to posteriors (see the module's text)."""
    state = written(spark, post.withColumn("rate", F.lit(1.0)), "rates")

    def sums(x: Column) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens of each domain, and H."""
        n, p = F.col("n_tokens"), [F.col(f"p_{d}") for d in DOMAINS]
        live = F.when(x > 0, n).otherwise(0)
        got = state.agg(*[F.sum(n * a * x) for a in p], *[F.sum(live * a * b) for a in p for b in p]).first()
        got = np.array([v or 0.0 for v in got])
        return got[:len(p)], got[len(p):].reshape(len(p), len(p))

    got, h = sums(F.lit(1.0))
    use = [i for i, d in enumerate(DOMAINS) if got[i] > 0 and weights.get(d, 0) > 0]
    if anchor not in [DOMAINS[i] for i in use] or len(use) < 2:
        return state
    target = {i: got[DOMAINS.index(anchor)] * weights[DOMAINS[i]] / weights[anchor] for i in use}
    x, step, was = F.col("rate"), 1.0, np.inf
    for t in range(1, ROUNDS + 1):
        miss = np.array([got[i] - target[i] for i in use])
        worst = max(abs(got[i] / target[i] - 1) for i in use)
        if worst < NEAR:
            break
        step = step / 2 if worst > 0.9 * was else min(1.0, step * 1.5)
        was = worst
        g = step * np.linalg.lstsq(h[np.ix_(use, use)], miss, rcond=1e-12)[0]
        x = F.greatest(F.lit(0.0), x - sum((F.col(f"p_{DOMAINS[i]}") * float(v) for i, v in zip(use, g)), F.lit(0.0)))
        if t % REWRITE == 0:
            state = written(spark, state.withColumn("rate", x), "rates")
            x = F.col("rate")
        got, h = sums(x)
    return state.withColumn("rate", x)


def mixed(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Posteriors, rate and whole ``copies`` of every document."""
    rated = solve_rates(spark, written(spark, posteriors(spark, docs, labels), "posteriors"))
    even = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", (F.floor("rate") + (even < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), *[f"p_{d}" for d in DOMAINS], "rate", "copies")
