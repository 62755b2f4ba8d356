"""Helpers shared by the operators: tables, the shared folder, written tables
that cut lineage, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

_SCRATCH: dict[str, str] = {}
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Where it is unset, a scratch
    folder is made, and only on a local master: executors of a cluster could
    not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="tidepool-llm-")
    return _SCRATCH[app]


def short_plans(spark: SparkSession) -> None:
    """Keep at most 20,000 characters of a plan's description: the driver holds
    the descriptions of the last thousand queries, and those of plans with large
    literals are megabytes each."""
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")


def small_batches(spark: SparkSession) -> None:
    """Give Python rows in Arrow batches of about 4 MB: ten thousand whole texts at
    a time are held several times over, by the executor and by each worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_NOTED: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _NOTED:
        paths.append(path)
    return path


@contextmanager
def noting(paths: list[str]):
    """Note in ``paths`` the folders that are written meanwhile, so that the
    caller can delete them once nothing reads them any more."""
    _NOTED.append(paths)
    try:
        yield
    finally:
        _NOTED.remove(paths)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, survives lost executors, and later reads prune columns."""
    short_plans(spark)
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidepool_path = path
    return out


def delete_path(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table made by ``written`` that no later step reads."""
    delete_path(spark, df._tidepool_path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def merged(df: DataFrame) -> DataFrame:
    """``df`` for a join that is not to be broadcast. Spark takes the compressed files
    of ``written`` for the size of the rows, which are ten or a hundred times that
    (paths, ids, arrays), and a broadcast table is built in the driver."""
    return df.hint("merge")


def with_place(docs: DataFrame) -> DataFrame:
    """Add ``place_file`` and ``place_row``, which name a row of a table in files for good."""
    try:
        return docs.select("*", F.col("_metadata.file_path").alias("place_file"), F.col("_metadata.row_index").alias("place_row"))
    except AnalysisException:  # not a file source
        return docs.select("*", F.lit("").alias("place_file"), F.monotonically_increasing_id().alias("place_row"))


def bit_array(spark: SparkSession, at: DataFrame, bits: int) -> Column:
    """The positions ``at(at)`` below ``bits`` as one array of 64-bit words (a
    scalar subquery of ``bits / 8`` bytes). Words are or-ed together where the
    positions are, then by word."""
    one = at.select(F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bits"))
    every = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = written(spark, one.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits")), "bits")
    inorder = F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"])
    return words.agg(inorder.alias("words")).scalar()


def bit_at(words: Column, at: Column) -> Column:
    return F.getbit(F.element_at(words, (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1


def likely(spark: SparkSession, keys: DataFrame, columns: list[str], bits: int = 1 << 24):
    """A condition on ``columns`` that every row of ``keys`` meets and few
    others do, for use before a join: it keeps rows without a partner from
    being moved. 2 MB whatever the size; when crowded it lets more rows pass."""
    def slot(seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(bits))

    words = bit_array(spark, keys.select(F.explode(F.array(slot(1), slot(2))).alias("at")), bits)
    return bit_at(words, slot(1)) & bit_at(words, slot(2))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long ids): rows ``(node, root)``
    for every node of an edge, root being its smallest reachable id.

    Alternating star contraction: each round is two min-aggregations (combined
    before the shuffle) joined back to the edges, so a node with very many
    neighbours is split by the skew join; rounds grow with the logarithm of
    the graph. Every round is written to the shared folder.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(spark, e, "cc")

    def state() -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first())

    mark = state()
    while mark[0]:
        # large star: every larger neighbour of u points to u's smallest
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        # small star: u and its smaller neighbours point to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        old, e = e, written(spark, small, "cc")
        drop_written(spark, old)
        was, mark = mark, state()
        if was == mark:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
