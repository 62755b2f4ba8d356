"""Filter interaction audit: what each filter removes in every order of the filters.

A row's ``mask`` says which filters it fails. Applied left to right, an order
removes the row at the first filter that is in its mask. All orders that share
a beginning have neighbouring lexicographic (Lehmer) ranks, so a mask's removal
at step k covers intervals of ranks: one for every beginning of k - 1 filters
outside the mask followed by one inside it. ``rank_intervals`` lists them (840
for five filters, a rule of the number of filters alone).

``audit`` counts rows by (part, mask), which is combined before the shuffle and
leaves at most 2^n rows a part, adds each count at the beginning of its
intervals and takes it off at their end, and sums these differences along the
ranks: per part n * (n! + 1) numbers, whatever the size of the part. All other
columns follow from them and from the counts by mask.

Defined results: a null part is the empty string (and one part with it); a null
mask fails nothing; an empty table gives no rows; repeated rows count as often
as they are there. ``filter_masks``: a null text is empty; texts of any length
are read whole; a row with a null doc_id has no smaller doc_id and is nobody's
smaller one; rows that share doc_id and text are not copies of each other; a
doc_id with several label rows is good or toxic if one of them says so. Columns
other than those named are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import table, written

FILTERS = "ABCDE"
MAX_FILTERS = 7  # 5,040 orders a part
WORD = r"[^\x20\x09-\x0D]+"
SUMS = ["n", "good", "toxic"]


def lehmer_rank(beginning: tuple[int, ...], n: int) -> int:
    """Rank of the first order, among all n! in lexicographic sequence, that begins so."""
    left, rank = list(range(n)), 0
    for i, f in enumerate(beginning):
        rank += left.index(f) * factorial(n - 1 - i)
        left.remove(f)
    return rank


def rank_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """Rows ``(mask, step, first, after)``: the orders with ranks from ``first``
    to before ``after`` remove a row of this mask at this step."""
    out = []
    for step in range(1, n + 1):
        for beginning in permutations(range(n), step):
            first = lehmer_rank(beginning, n)
            later = [f for f in range(n) if f not in beginning]
            for k in range(len(later) + 1):
                for more in combinations(later, k):
                    mask = sum(1 << f for f in (beginning[-1], *more))
                    out.append((mask, step, first, first + factorial(n - step)))
    return out


def audit(spark: SparkSession, rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``rows``: part, mask (bit i: fails ``filters[i]``), good, toxic (booleans).
    One row per part, order of the filters and step."""
    n = len(filters)
    if not 1 <= n <= MAX_FILTERS or len(set(filters)) != n:
        raise ValueError(f"1 to {MAX_FILTERS} different filters")
    one = F.lit(1).cast("long")
    counts = written(spark, rows.groupBy(F.coalesce("part", F.lit("")).alias("part"), F.coalesce("mask", F.lit(0)).alias("mask")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("good"), one)).alias("good"), F.count(F.when(F.col("toxic"), one)).alias("toxic")), "masks")

    # differences at the ends of the intervals, and a zero for every rank
    intervals = spark.createDataFrame(rank_intervals(n), "mask int, step int, first int, after int")
    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("after").alias("rank"), F.lit(-1).alias("sign"))))
    moved = counts.join(intervals, "mask").select("part", "step", ends.alias("end"), *SUMS).select(
        "part", "step", "end.rank", *[(F.col(c) * F.col("end.sign")).alias(c) for c in SUMS])
    grid = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in SUMS])
    steps = moved.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in SUMS])
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = steps.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in SUMS]).where(F.col("rank") < factorial(n))

    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    removed = removed.withColumn("filter_order", F.element_at(orders, F.col("rank") + 1))
    removed = removed.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))

    fails = [F.sum(F.when(F.getbit("mask", F.lit(i)) == 1, F.col("n")).otherwise(0)) for i in range(n)]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n)]
    whole = counts.groupBy("part").agg(F.sum("n").alias("whole"), *[
        F.struct(F.lit(f).alias("letter"), a.alias("fails"), b.alias("alone")).alias(f"__{i}")
        for i, (f, a, b) in enumerate(zip(filters, fails, alone))])
    whole = whole.select("part", "whole", F.explode(F.array(*[f"__{i}" for i in range(n)])).alias("f")).select("part", "whole", "f.*")

    before = Window.partitionBy("part", "rank").orderBy("step")
    gone = removed.join(whole, ["part", "letter"]).withColumn("gone", F.sum("n").over(before))
    every = Window.partitionBy("part", "letter")
    return gone.select(
        "part", "filter_order", "step", (F.col("whole") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), F.col("alone").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(every).alias("shapley"))


def _bit(failed: Column, i: int) -> Column:
    return F.when(failed, 1 << i).otherwise(0)


def filter_masks(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows for ``audit`` by the five filters: A under 200 words; B under half of
    the words distinct; C over 2 % capitals; D a character of ``#$%&*|``; E a
    copy of a text with a smaller doc_id. Texts are read once and named by their
    SHA-256; what is joined afterwards has no text."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    told = read.select("doc_id", "part", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    n_words, n_text = F.size("words"), F.length("text")
    capitals = n_text - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    mask = (_bit(n_words < 200, 0) + _bit(100 * F.size(F.array_distinct("words")) < 50 * n_words, 1)
            + _bit(100 * capitals.cast("long") > 2 * n_text.cast("long"), 2) + _bit(F.col("text").rlike(r"[#$%&*|]"), 3))
    told = written(spark, told.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("name")), "filters")
    # the first of each text, by name and doc_id: a name with very many copies is spread by their doc_ids
    first = told.groupBy("name").agg(F.min("doc_id").alias("doc_id")).select("name", "doc_id", F.lit(False).alias("copy"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    copy = F.coalesce("copy", F.col("doc_id").isNotNull())
    return told.join(first, ["name", "doc_id"], "left").join(known, "doc_id", "left").select("part", (F.col("mask") + _bit(copy, 4)).alias("mask"), "good", "toxic")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, filter_masks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


# Another way to the same rows: each order's step of removal from the places of a mask's letters in it.
OP11_SQL = r"""
WITH told AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
known AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
marked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN told.doc_id > min(told.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS mask
  FROM told LEFT JOIN known ON told.doc_id = known.doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
places AS (
  SELECT part, mask, n, good, toxic, filter_order,
         coalesce(list_min(list_transform(string_split(nullif(mask, ''), ''), lambda x: strpos(filter_order, x))), 9) AS gone_at
  FROM counts, orders),
steps AS (
  SELECT part, filter_order, step, substring(filter_order, step, 1) AS f,
         sum(n) FILTER (WHERE gone_at > step) AS kept, sum(n) FILTER (WHERE gone_at = step) AS removed,
         sum(n) FILTER (WHERE gone_at < step AND strpos(mask, substring(filter_order, step, 1)) > 0) AS redundant,
         sum(n) FILTER (WHERE mask = substring(filter_order, step, 1)) AS unique_fails,
         sum(good) FILTER (WHERE gone_at = step) AS good_lost, sum(toxic) FILTER (WHERE gone_at = step) AS toxic_lost
  FROM places, (SELECT unnest(range(1, 6)) AS step) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM steps
"""
