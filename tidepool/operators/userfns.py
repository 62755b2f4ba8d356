"""User functions over keyed and windowed rows (UDF-2, UDF-4, UDF-5, UDF-6, UDF-9).

Python is what the caller brings, so rows go through it in Arrow batches. What
Spark can do without it stays outside: windows are assigned, rows shuffled and
groups formed by DataFrame operations.

Aggregates are mergeable: every task folds its rows into one partial state per
(key, pane) before the shuffle, so a hot key sends one state per task; states
are merged per pane and panes into windows. A window body (UDF-6) and a co-group
body (UDF-9) see all rows of a (key, window) by definition: as iterators over
Arrow batches, so a body that streams through them holds one batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import gcd
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidepool.operators.windows import floor_to, window_starts

HELD = 100_000  # states that a task holds before it sends them on


@dataclass(frozen=True)
class Aggregate:
    """UDF-5: ``zero()`` is an empty state, ``add(state, row)`` folds a row (a
    tuple of the input columns) in, ``merge(a, b)`` joins two states of the same
    key, ``result(state)`` gives a tuple for ``schema`` (DDL). States are any
    picklable values; ``add`` and ``merge`` may change and return their first."""

    zero: Callable[[], Any]
    add: Callable[[Any, tuple], Any]
    merge: Callable[[Any, Any], Any]
    result: Callable[[Any], tuple]
    schema: str


def reduce_aggregate(fn: Callable[[tuple, tuple], tuple], schema: str) -> Aggregate:
    """UDF-4: an associative ``fn(row, row) -> row`` as an aggregate."""
    fold = lambda a, b: b if a is None else a if b is None else fn(a, b)
    return Aggregate(lambda: None, fold, fold, lambda state: state, schema)


def _rows(batch: pa.RecordBatch | pa.Table, first: int, last: int) -> Iterator[tuple]:
    return zip(*(batch.column(i).to_pylist() for i in range(first, last)))


def _ddl(df: DataFrame, cols: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"{c} {kinds[c]}" for c in cols)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, schema.types)], schema=schema)


def _schema_of(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def partial_states(df: DataFrame, keys: list[str], inputs: list[str], agg: Aggregate) -> DataFrame:
    """(keys, ``__state``): one state per key and task (or per ``HELD`` keys of it)."""
    out = _schema_of(f"{_ddl(df, keys)}, __state binary")
    n, zero, add = len(keys), agg.zero, agg.add

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        for b in batches:
            for key, row in zip(_rows(b, 0, n), _rows(b, n, n + len(inputs))):
                held[key] = add(held[key] if key in held else zero(), row)
            if len(held) > HELD:
                yield _arrow([(*k, pickle.dumps(s)) for k, s in held.items()], out)
                held = {}
        yield _arrow([(*k, pickle.dumps(s)) for k, s in held.items()], out)

    return df.select(*keys, *inputs).mapInArrow(fold, f"{_ddl(df, keys)}, __state binary")


def _merged(states: DataFrame, keys: list[str], agg: Aggregate, final: bool) -> DataFrame:
    """States of a key merged into one, or into its result."""
    ddl = f"{_ddl(states, keys)}, {agg.schema if final else '__state binary'}"
    out, n, merge, result = _schema_of(ddl), len(keys), agg.merge, agg.result

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, first = None, None, True
        for b in batches:
            for *k, s in _rows(b, 0, n + 1):
                key, other = k, pickle.loads(s)
                state, first = other if first else merge(state, other), False
        yield _arrow([(*key, *(result(state) if final else (pickle.dumps(state),)))], out)

    return states.select(*keys, "__state").groupBy(*keys).applyInArrow(_streamed(run), ddl)


def _streamed(run):
    """A function of an iterator of batches as Spark's grouped Arrow iterator function."""
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)

    group.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return group


def user_aggregate(df: DataFrame, keys: list[str], inputs: list[str], agg: Aggregate) -> DataFrame:
    """UDF-5 / UDF-4 per key: keys and the aggregate's result."""
    return _merged(partial_states(df, keys, inputs, agg), keys, agg, final=True)


def window_user_aggregate(df: DataFrame, ts: str, size_s: int, slide_s: int | None, keys: list[str],
                          inputs: list[str], agg: Aggregate) -> DataFrame:
    """UDF-5 in tumbling or sliding windows: keys, ``window_start``,
    ``window_end`` (epoch ms) and the result.

    Rows are folded into panes of ``gcd(size, slide)`` where they are read,
    states are merged per (key, pane), and only one state a pane is copied to
    the windows that hold it.
    """
    slide_s = slide_s or size_s
    pane_us = gcd(int(size_s), int(slide_s)) * 1_000_000
    timed = df.where(F.col(ts).isNotNull()).select(*keys, floor_to(F.unix_micros(F.col(ts)), pane_us).alias("__pane"), *inputs)
    panes = _merged(partial_states(timed, [*keys, "__pane"], inputs, agg), [*keys, "__pane"], agg, final=False)
    start = F.explode(window_starts(F.col("__pane"), size_s, slide_s)).alias("__ws")
    done = _merged(panes.select(*keys, start, "__state"), [*keys, "__ws"], agg, final=True)
    begin = F.expr("__ws div 1000")
    return done.select(*keys, begin.alias("window_start"), (begin + int(size_s) * 1000).alias("window_end"),
                       *[c for c in done.columns if c not in (*keys, "__ws")])


def window_apply(df: DataFrame, ts: str, size_s: int, slide_s: int | None, keys: list[str], inputs: list[str],
                 body: Callable[[tuple, tuple[int, int], Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """UDF-6: a window body. ``body(key, (start_ms, end_ms), rows)`` yields result
    tuples of ``schema``; ``rows`` iterates over tuples of ``inputs`` in no
    particular order, batch by batch. Output: keys, window bounds, results."""
    slide_s = slide_s or size_s
    starts = F.transform(window_starts(F.unix_micros(F.col(ts)), size_s, slide_s), lambda t: (t / 1000).cast("bigint"))
    rows = df.where(F.col(ts).isNotNull()).select(*keys, F.explode(starts).alias("window_start"), *inputs)
    by = [*keys, "window_start"]
    ddl = f"{_ddl(df, keys) + ', ' if keys else ''}window_start bigint, window_end bigint, {schema}"
    out, n, m, size_ms = _schema_of(ddl), len(by), len(inputs), int(size_s) * 1000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        *key, start = next(_rows(first.slice(0, 1), 0, n))

        def every():
            yield from _rows(first, n, n + m)
            for b in batches:
                yield from _rows(b, n, n + m)

        window = (start, start + size_ms)
        yield from _in_batches(((*key, *window, *r) for r in body(tuple(key), window, every())), out)

    return rows.groupBy(*by).applyInArrow(_streamed(run), ddl)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield _arrow(held, schema)
            held = []
    yield _arrow(held, schema)


def window_cogroup(left: DataFrame, right: DataFrame, keys: list[str], ts: str, size_s: int,
                   left_inputs: list[str], right_inputs: list[str],
                   body: Callable[[tuple, tuple[int, int], Iterator[tuple], Iterator[tuple]], Iterator[tuple]],
                   schema: str) -> DataFrame:
    """UDF-9: co-grouped tumbling windows. ``body(key, (start_ms, end_ms), left
    rows, right rows)`` is called once for every (key, window) that either side
    has rows in and yields result tuples of ``schema``. A NULL key is a key of
    its own; rows without a time are in no window."""
    size_us = int(size_s) * 1_000_000

    def side(df: DataFrame, inputs: list[str]) -> DataFrame:
        start = floor_to(F.unix_micros(F.col(ts)), size_us) / 1000
        return df.where(F.col(ts).isNotNull()).select(*keys, start.cast("bigint").alias("window_start"), *inputs)

    by = [*keys, "window_start"]
    ddl = f"{_ddl(left, keys)}, window_start bigint, window_end bigint, {schema}"
    out, n, size_ms = _schema_of(ddl), len(by), int(size_s) * 1000

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        *key, start = next(_rows((a if a.num_rows else b).slice(0, 1), 0, n))
        window = (start, start + size_ms)
        rows = body(tuple(key), window, _each(a, n), _each(b, n))
        return pa.Table.from_batches(_in_batches(((*key, *window, *r) for r in rows), out), out)

    return side(left, left_inputs).groupBy(*by).cogroup(side(right, right_inputs).groupBy(*by)).applyInArrow(run, ddl)


def _each(table: pa.Table, first: int) -> Iterator[tuple]:
    for b in table.to_batches(max_chunksize=10_000):
        yield from _rows(b, first, table.num_columns)


def map_with_setup(df: DataFrame, setup: Callable[[], Any], fn: Callable[[Any, tuple], Iterator[tuple]],
                   teardown: Callable[[Any], None] | None, schema: str) -> DataFrame:
    """UDF-2: a rich map. ``setup()`` opens a resource once per task,
    ``fn(resource, row)`` yields result tuples of ``schema`` for every row (a
    tuple of all columns), ``teardown(resource)`` closes it, also after an error."""
    out = _schema_of(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource = setup()
        try:
            for b in batches:
                yield _arrow([r for row in _rows(b, 0, b.num_columns) for r in fn(resource, row)], out)
        finally:
            if teardown is not None:
                teardown(resource)

    return df.mapInArrow(run, schema)
