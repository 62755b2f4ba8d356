"""The corpus pipeline: five stages over ``documents``, each by one operator.

Every stage gets (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of their docs; the last adds ``shard`` and ``slot``.

1. language ID: texts without a letter and texts whose language stays
   ambiguous with a score under ``MIN_SCORE`` go;
2. n-gram Jaccard join (five words, 0.8): of each component one document stays,
   the one with the smallest doc_id (ties: the first in the table);
3. benchmark decontamination: contaminated documents go;
4. mixing: each document is there ``copies`` times;
5. sharding: every document gets its shard and its slot.

Rows, null doc_ids and texts, repeated rows and extra columns are treated as
the operators' modules define. No SQL expresses a trained classifier, so
``ORACLE_SQL`` is None; ``tests/llm`` runs the stages against brute force.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import decontamination, jaccard_join, language_id, mixing, sharding
from tidepool.llm.common import delete_path, likely, merged, new_path, noting, short_plans, small_batches, table, with_place, written

MIN_SCORE = 0.5
N_SHARDS = 16
PLACE = ["place_file", "place_row"]


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _met(spark: SparkSession, docs: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """``docs``, packed as ``__doc``, with their places in two parts: rows that ``places`` (of
    ``__file``, ``__row``) may name, and the others, which need not be moved;
    and the condition that joins the first part to ``places``."""
    d = with_place(docs.select(F.struct(*_columns(docs)).alias("__doc")))
    some = places.select(F.col("__file").alias("place_file"), F.col("__row").alias("place_row"))
    may = likely(spark, some, PLACE)
    return d.where(may), d.where(~may), (F.col("place_file") == F.col("__file")) & (F.col("place_row") == F.col("__row"))


def _without(spark: SparkSession, docs: DataFrame, places: DataFrame) -> DataFrame:
    """``docs`` without the rows at ``places``."""
    gone = written(spark, places.select(F.col("place_file").alias("__file"), F.col("place_row").alias("__row")), "gone")
    may, other, on = _met(spark, docs, gone)
    return may.join(merged(gone), on, "left_anti").select("__doc.*").unionByName(other.select("__doc.*"))


def _stage(step):
    @wraps(step)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_plans(spark)
        small_batches(spark)
        return step(spark, docs, sf_dir)

    return stage


@_stage
def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judge = language_id.predictor(language_id.fit_documents(docs))
    told = docs.select(*_columns(docs), judge("text").alias("__judged"))
    p = F.col("__judged")
    keep = (p["lang_pred"] != "und") & ~(p["ambiguous"] & (p["score"] < MIN_SCORE))
    return told.where(keep).drop("__judged")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sets = written(spark, jaccard_join.similar_sets(spark, docs, 5, 80, 100), "similar")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *PLACE)).alias("at")
    stays = sets.where("root IS NOT NULL").groupBy("root").agg(best).select("at.place_file", "at.place_row")
    return _without(spark, docs, sets.where("root IS NOT NULL").join(stays, PLACE, "left_anti"))


@_stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(spark, docs, table(spark, sf_dir, "benchmark"))
    return _without(spark, docs, found.select(*PLACE).distinct())


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rated = mixing.mixed(spark, docs, table(spark, sf_dir, "labels"))
    changed = written(spark, rated.where("copies != 1").select(
        F.col("place_file").alias("__file"), F.col("place_row").alias("__row"), F.col("copies").cast("int").alias("__copies")), "copies")
    may, other, on = _met(spark, docs, changed)
    times = F.array_repeat(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)))
    copied = may.join(changed, on, "left").select("__doc", F.explode(times).alias("__copy"))
    return copied.select("__doc.*").unionByName(other.select("__doc.*"))


@_stage
def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, docs, N_SHARDS)


STAGES = [
    ("language_id", languages),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage wrote for itself, and its input, are deleted once
    its result is written; the returned frame reads what the last stage wrote."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        own: list[str] = []
        with noting(own):
            result = stage(spark, docs, sf_dir)
        path = new_path(spark, f"stage-{name}")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        for p in [*own, *([before] if before else [])]:
            delete_path(spark, p)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = run
