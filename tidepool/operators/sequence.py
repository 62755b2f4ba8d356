"""Skew-safe keyed ordered scans.

Sequential logic per key (previous row, next row, running sums, running
min/max, row index) is usually written as ``Window.partitionBy(key)``; that
puts every row of a key into one task, which fails when a single key holds a
large share of the data.

``keyed_scan`` splits each key into time buckets of ``split_seconds``:

1. rows are dealt to ``(key, bucket)`` by one hash shuffle (``deal``), and local
   window functions run there;
2. a per-``(key, bucket)`` summary is aggregated where the rows lie, from the same
   shuffle (it is reused, so the input is read once), and turned into a carry by a
   window over the *summary* (one row per bucket, so a hot key contributes only
   #buckets rows);
3. the carry is joined back on ``(key, bucket)`` — the big side is already
   partitioned on those columns, only the carry moves.

Scans of scans (``dealt_scan`` on its own result) stay on that one shuffle of the
rows. Results are exact; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow

DEFAULT_SPLIT_SECONDS = 3600


def bucket_col(ts: str, split_seconds: int) -> Column:
    """Time bucket id used to split a key into independently sorted segments."""
    return F.expr(f"unix_micros(`{ts}`) div {int(split_seconds) * 1_000_000}")


def _ord(cols: list[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in cols]


def deal(df: DataFrame, keys: list[str], ts: str, split_seconds: int = DEFAULT_SPLIT_SECONDS) -> DataFrame:
    """``df`` shuffled to ``(keys, __ks_b)``, the time buckets.

    The other columns travel as one struct that is opened behind the shuffle by
    a generator. Column pruning does not reach through it, so every use of the
    result has the same shuffle below it and Spark runs that shuffle once. Pass
    only the columns that are needed.
    """
    rest = [F.col(c) for c in df.columns if c not in keys] or [F.lit(0).alias("__ks_none")]
    packed = df.select(*keys, bucket_col(ts, split_seconds).alias("__ks_b"), F.struct(*rest).alias("__ks_row"))
    opened = packed.repartition(*keys, "__ks_b").select(*keys, "__ks_b", F.inline(F.array("__ks_row")))
    return opened.select(*df.columns, "__ks_b")


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], ts: str, *,
               running: dict[str, tuple[str, Column]] | None = None,
               prev: list[str] | None = None, nxt: list[str] | None = None,
               key_first: list[str] | None = None, index: str | None = None,
               reverse: bool = False, exclusive: bool = False,
               split_seconds: int = DEFAULT_SPLIT_SECONDS) -> DataFrame:
    """Add per-key scan columns to ``df`` in the order given by ``order``.

    ``order`` must be a total order within a key (e.g. ``[ts, event_id]``) and
    its first column must be the timestamp ``ts`` (buckets follow it). Rows
    with a NULL key are a key of their own; NULL times come first.

    * ``running``: ``{out: (kind, expr)}`` with kind ``sum``/``min``/``max`` —
      running aggregate from the key's first row (or, with ``reverse=True``,
      from its last row backwards: a suffix aggregate), up to and including the
      row, or with ``exclusive=True`` up to the row before it.
    * ``prev`` / ``nxt``: columns ``c`` -> ``prev_c`` / ``next_c`` (NULL at the
      key's first / last row).
    * ``key_first``: columns ``c`` -> ``first_c`` (value at the key's first row).
    * ``index``: 1-based row number within the key (forward order).
    """
    return dealt_scan(deal(df, keys, ts, split_seconds), keys, order, running=running, prev=prev, nxt=nxt,
                      key_first=key_first, index=index, reverse=reverse, exclusive=exclusive).drop("__ks_b")


def dealt_scan(base: DataFrame, keys: list[str], order: list[str], *,
               running: dict[str, tuple[str, Column]] | None = None,
               prev: list[str] | None = None, nxt: list[str] | None = None,
               key_first: list[str] | None = None, index: str | None = None,
               reverse: bool = False, exclusive: bool = False) -> DataFrame:
    """``keyed_scan`` on rows that ``deal`` has dealt; they stay dealt."""
    running = dict(running or {})
    prev, nxt, key_first = list(prev or []), list(nxt or []), list(key_first or [])
    kb = keys + ["__ks_b"]
    for name, (_, expr) in running.items():
        base = base.withColumn(f"__ks_v_{name}", expr)
    if index:
        base = base.withColumn("__ks_v_index", F.lit(1))
    fn = {"sum": F.sum, "min": F.min, "max": F.max}

    # 1. local pass per (key, bucket)
    wf = Window.partitionBy(*kb).orderBy(*_ord(order, False))
    wd = Window.partitionBy(*kb).orderBy(*_ord(order, reverse)).rowsBetween(_UNB, -1 if exclusive else _CUR)
    loc = base
    for name, (kind, _) in running.items():
        loc = loc.withColumn(f"__ks_l_{name}", fn[kind](f"__ks_v_{name}").over(wd))
    if index:
        loc = loc.withColumn("__ks_l_index", F.row_number().over(wf).cast("bigint"))
    for c in prev:
        loc = loc.withColumn(f"__ks_lp_{c}", F.lag(c).over(wf))
    for c in nxt:
        loc = loc.withColumn(f"__ks_ln_{c}", F.lead(c).over(wf))
    if prev:
        loc = loc.withColumn("__ks_is_first", F.lag(F.lit(1)).over(wf).isNull())
    if nxt:
        loc = loc.withColumn("__ks_is_last", F.lead(F.lit(1)).over(wf).isNull())

    # 2. bucket summary (where the rows lie), carry across buckets
    order_struct = F.struct(*[F.col(c) for c in order])
    aggs = [fn[kind](f"__ks_v_{name}").alias(f"__ks_t_{name}") for name, (kind, _) in running.items()]
    if index:
        aggs.append(F.count(F.lit(1)).alias("__ks_t_index"))
    first_cols = sorted(set(nxt + key_first))
    if first_cols:
        aggs.append(F.min_by(F.struct(*first_cols), order_struct).alias("__ks_bfirst"))
    if prev:
        aggs.append(F.max_by(F.struct(*prev), order_struct).alias("__ks_blast"))
    if not aggs:
        return loc
    summ = base.groupBy(*kb).agg(*aggs)
    wk = Window.partitionBy(*keys).orderBy(F.col("__ks_b"))
    wkd = Window.partitionBy(*keys).orderBy(F.col("__ks_b").desc() if reverse else F.col("__ks_b"))
    carry_cols = list(kb)
    for name, (kind, _) in running.items():
        summ = summ.withColumn(f"__ks_c_{name}", fn[kind](f"__ks_t_{name}").over(wkd.rowsBetween(_UNB, -1)))
        carry_cols.append(f"__ks_c_{name}")
    if index:
        summ = summ.withColumn("__ks_c_index", F.sum("__ks_t_index").over(wk.rowsBetween(_UNB, -1)))
        carry_cols.append("__ks_c_index")
    if prev:
        summ = summ.withColumn("__ks_carry_prev", F.lag("__ks_blast").over(wk))
        carry_cols.append("__ks_carry_prev")
    if nxt:
        summ = summ.withColumn("__ks_carry_next", F.lead("__ks_bfirst").over(wk))
        carry_cols.append("__ks_carry_next")
    if key_first:
        summ = summ.withColumn("__ks_carry_kfirst", F.first("__ks_bfirst").over(wk.rowsBetween(_UNB, _CUR)))
        carry_cols.append("__ks_carry_kfirst")
    # null-safe: rows without a key or a time form a key or a bucket of their own
    carry = summ.select(*[F.col(c).alias(f"__ks_k{i}") if c in kb else F.col(c) for i, c in enumerate(carry_cols)])
    same = [F.col(c).eqNullSafe(F.col(f"__ks_k{i}")) for i, c in enumerate(kb)]
    out = loc.join(carry, on=same, how="inner")

    # 3. combine local values with the carry
    for name, (kind, _) in list(running.items()) + ([("index", ("sum", None))] if index else []):
        local, carry = F.col(f"__ks_l_{name}"), F.col(f"__ks_c_{name}")
        if kind == "sum":
            val = F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
        elif kind == "min":
            val = F.least(local, carry)
        else:
            val = F.greatest(local, carry)
        out = out.withColumn(index if name == "index" else name, val)
    for c in prev:
        out = out.withColumn(f"prev_{c}", F.when(F.col("__ks_is_first"), F.col("__ks_carry_prev")[c])
                             .otherwise(F.col(f"__ks_lp_{c}")))
    for c in nxt:
        out = out.withColumn(f"next_{c}", F.when(F.col("__ks_is_last"), F.col("__ks_carry_next")[c])
                             .otherwise(F.col(f"__ks_ln_{c}")))
    for c in key_first:
        out = out.withColumn(f"first_{c}", F.col("__ks_carry_kfirst")[c])
    return out.drop(*[c for c in out.columns if c.startswith("__ks") and c != "__ks_b"])


def shifted(df: DataFrame, keys: list[str], index: str, cols: list[str], k: int,
            prefix: str) -> DataFrame:
    """Attach the values of ``cols`` from the row ``k`` positions earlier in the
    key (by the 1-based ``index`` from ``keyed_scan``).

    An equi-join on ``(keys, index)``: hash partitioning on the index spreads a
    hot key over all partitions.
    """
    right = df.select(*keys, (F.col(index) + k).alias(index),
                      *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    return df.join(right, on=keys + [index], how="left")
