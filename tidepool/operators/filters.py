"""Filters, routing and set operations (FIL-1..6, SET-1..2, PRJ-9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_by(df: DataFrame, predicates: dict[str, Column], default: str | None = None,
             label: str = "label") -> DataFrame:
    """FIL-5: label each row with the first matching predicate (or ``default``)."""
    expr = None
    for name, pred in predicates.items():
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    expr = expr.otherwise(F.lit(default)) if default is not None else expr
    return df.withColumn(label, expr)


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """FIL-4: ``col`` starts with ``prefix`` (pushed to the scan as a string filter)."""
    return df.where(F.col(col).startswith(prefix))


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """FIL-3: drop NULL and empty strings."""
    return df.where(F.length(F.col(col)) > 0)


def threshold_alert(df: DataFrame, pred: Column, msg: Column) -> tuple[DataFrame, DataFrame]:
    """FIL-6: every row stays in the main output; matching rows also go to a
    side output carrying ``msg``. Returns ``(main, side)``."""
    return df, df.where(pred).select("*", msg.alias("msg"))


def tag_outputs(main: DataFrame, side: DataFrame, tag: str = "output") -> DataFrame:
    """Main + side outputs as one tagged DataFrame (for a single-pass SNK-7 write)."""
    return (main.withColumn(tag, F.lit("main"))
                .unionByName(side.withColumn(tag, F.lit("side")), allowMissingColumns=True))


def union_all(*dfs: DataFrame) -> DataFrame:
    """SET-1: bag union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def connect_map(a: DataFrame, fa: Callable[[DataFrame], DataFrame], b: DataFrame,
                fb: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """SET-2: map two differently shaped inputs and merge them into one output
    (missing columns become NULL)."""
    return fa(a).unionByName(fb(b), allowMissingColumns=True)


def with_partition(df: DataFrame, out: str = "partition") -> DataFrame:
    """PRJ-9: tag rows with the index of the partition that processes them."""
    return df.withColumn(out, F.spark_partition_id())
