"""Top-N per group (TOP-1..4).

``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit``
before the shuffle, so each map task ships at most ``n`` rows per group even
when one group (one window) holds most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, partition: list[str], by: str, tie: list[str], n: int,
          rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per ``partition`` by ``by`` desc, ties by ``tie`` asc."""
    w = Window.partitionBy(*partition).orderBy(F.col(by).desc(), *[F.col(t).asc() for t in tie])
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= n)
              .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def render_ranking(ranked: DataFrame, partition: str, key: str, count: str,
                   rank_col: str = "rank", out: str = "report") -> DataFrame:
    """TOP-4: one text block per partition value: ``No1: id=.. count=..`` lines.

    The input holds at most n rows per group (after ``top_n``), so the
    ``collect_list`` per group is bounded by n.
    """
    line = F.format_string("No%d: id=%s count=%d", F.col(rank_col), F.col(key).cast("string"),
                           F.col(count))
    return (ranked.groupBy(partition)
                  .agg(F.sort_array(F.collect_list(F.struct(rank_col, line.alias("l")))).alias("_ls"))
                  .select(partition, F.array_join(F.transform("_ls", lambda s: s["l"]), "\n").alias(out)))
