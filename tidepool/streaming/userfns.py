"""User functions on event-time windows of streams (UDF-5, UDF-6, UDF-9).

State is kept per (key, window) and leaves when the watermark passes the
window's end; rows of a window that it has passed are dropped. An aggregate's
state is merged in Python, closed by an event-time timer. Rows for a body wait
in Spark's own aggregate, which costs no Python call per (key, window) and
batch; a window's rows are one value there, so they must fit in 2 GB.
"""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Callable, Iterator
from itertools import islice
from math import gcd

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidepool.operators.userfns import Aggregate, _in_batches, _rows, _schema_of, partial_states
from tidepool.operators.windows import floor_to, window_starts
from tidepool.streaming.stateful import column_values


class WindowProcessor(StatefulProcessor):
    """Takes rows of a (key, window_start) and gives results when the window closes."""

    def __init__(self, size_s: int, out_columns: list[str]):
        self.size_ms, self.out_columns = int(size_s) * 1000, out_columns

    def init(self, handle) -> None:
        self.handle = handle
        self.open_state()

    def open_state(self) -> None:
        raise NotImplementedError

    def take(self, rows: Iterator[pd.DataFrame]) -> None:
        raise NotImplementedError

    def results(self, key: tuple, window: tuple[int, int]) -> Iterator[tuple]:
        raise NotImplementedError

    def clear(self) -> None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[-1]) + self.size_ms
        if timerValues.getCurrentWatermarkInMs() < end:
            self.take(rows)
            self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *own, start = key
        window = (int(start), int(start) + self.size_ms)
        held = []
        for r in self.results(tuple(own), window):
            held.append((*own, *window, *r))
            if len(held) == 10_000:
                yield pd.DataFrame(held, columns=self.out_columns, dtype=object)
                held = []
        if held:
            yield pd.DataFrame(held, columns=self.out_columns, dtype=object)
        self.clear()

    def close(self) -> None:
        pass


# Columns that a processor sees may not begin with an underscore (rows become named tuples): own ones begin with x.
def _tuples(rows: Iterator[pd.DataFrame], ddl: str) -> Iterator[tuple]:
    cols = [f.split()[:2] for f in ddl.split(", ")]
    for pdf in rows:
        yield from zip(*(column_values(pdf[c], kind) for c, kind in cols))


class AggregateProcessor(WindowProcessor):
    """One merged state of a user aggregate."""

    def __init__(self, size_s, out_columns, agg: Aggregate):
        super().__init__(size_s, out_columns)
        self.merge, self.result = agg.merge, agg.result

    def open_state(self):
        self.state = self.handle.getValueState("state", "state binary")

    def take(self, rows):
        state = pickle.loads(bytes(self.state.get()[0])) if self.state.exists() else None
        first = not self.state.exists()
        for (other,) in _tuples(rows, "x_state binary"):
            state, first = pickle.loads(bytes(other)) if first else self.merge(state, pickle.loads(bytes(other))), False
        self.state.update((pickle.dumps(state),))

    def results(self, key, window):
        return iter([tuple(self.result(pickle.loads(bytes(self.state.get()[0]))))])

    def clear(self):
        self.state.clear()


def _closing(rows: DataFrame, keys: list[str], processor: WindowProcessor, schema: str) -> DataFrame:
    return rows.groupBy(*keys, "window_start").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def _out(df: DataFrame, keys: list[str], schema: str) -> tuple[str, list[str]]:
    kinds = dict(df.dtypes)
    ddl = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "window_start bigint", "window_end bigint", schema])
    return ddl, [*keys, "window_start", "window_end", *[f.split()[0] for f in schema.split(",")]]


def _starts_ms(t_us, size_s: int, slide_s: int):
    return F.explode(F.transform(window_starts(t_us, size_s, slide_s), lambda t: (t / 1000).cast("bigint")))


def stream_window_user_aggregate(sdf: DataFrame, ts: str, size_s: int, slide_s: int | None, keys: list[str],
                                 inputs: list[str], agg: Aggregate, delay_s: int = 0) -> DataFrame:
    """UDF-5 on a stream: ``operators.userfns.window_user_aggregate``, each
    window once when it closes. Every task of a micro-batch folds its rows into
    one partial state per (key, pane) before the shuffle."""
    slide_s = slide_s or size_s
    pane_us = gcd(int(size_s), int(slide_s)) * 1_000_000
    timed = sdf.withWatermark(ts, f"{int(delay_s)} seconds").where(F.col(ts).isNotNull())
    panes = partial_states(timed.select(*keys, floor_to(F.unix_micros(F.col(ts)), pane_us).alias("__pane"), *inputs),
                           [*keys, "__pane"], inputs, agg)
    rows = panes.select(*keys, _starts_ms(F.col("__pane"), size_s, slide_s).alias("window_start"), F.col("__state").alias("x_state"))
    ddl, columns = _out(sdf, keys, agg.schema)
    return _closing(rows, keys, AggregateProcessor(size_s, columns, agg), ddl)


def _side(sdf: DataFrame, ts: str, keys: list[str], side: int, names: list[list[str]], inputs: list[list[str]], kinds: list[dict]) -> DataFrame:
    def own(c):  # a NaN counts as NULL
        return F.when(~F.isnan(c), F.col(c)) if kinds[side][c] in ("float", "double") else F.col(c)

    cols = [(own(c) if i == side else F.lit(None).cast(kinds[i][c])).alias(n)
            for i in range(len(names)) for c, n in zip(inputs[i], names[i])]
    return sdf.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("x_ts"), F.lit(side).alias("x_side"), *cols)


def _lists(column: pa.ListArray) -> Iterator[Iterator[tuple]]:
    """The rows of each list of structs, some thousand of them as Python objects at a time."""
    every = column.flatten()
    rows = (r for lo in range(0, len(every), 10_000) for r in zip(*(c.to_pylist() for c in every.slice(lo, 10_000).flatten())))
    for n in column.value_lengths().to_pylist():
        mine = islice(rows, n)
        yield mine
        deque(mine, maxlen=0)  # what the body left


def _bodies(sides: list[DataFrame], ts: str, size_s: int, slide_s: int, keys: list[str], inputs: list[list[str]], body, schema: str, delay_s: int) -> DataFrame:
    """Rows wait in a watermarked aggregate, one list a side for each (key,
    window); the lists of closed windows go through the body in Arrow batches.
    Python sees a window once, when it is complete."""
    kinds = [dict(d.dtypes) for d in sides]
    names = [[f"x{i}_{c}" for c in cols] for i, cols in enumerate(inputs)]
    parts = [_side(d.withWatermark(ts, f"{int(delay_s)} seconds"), ts, keys, i, names, inputs, kinds) for i, d in enumerate(sides)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    held = rows.groupBy(*keys, F.window("x_ts", f"{int(size_s)} seconds", f"{int(slide_s)} seconds").alias("x_window")).agg(
        *[F.collect_list(F.when(F.col("x_side") == i, F.struct(*cols))).alias(f"x_rows{i}") for i, cols in enumerate(names)])
    ddl, _ = _out(sides[0], keys, schema)
    out, n, size_ms = _schema_of(ddl), len(keys), int(size_s) * 1000

    def results(b: pa.RecordBatch) -> Iterator[tuple]:
        lists = [_lists(b.column(i)) for i in range(n + 1, b.num_columns)]
        for (*key, start), *some in zip(_rows(b, 0, n + 1), *lists):
            window = (start, start + size_ms)
            for r in body(tuple(key), window, *some):
                yield (*key, *window, *r)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _in_batches(results(b), out)

    closed = held.select(*keys, F.unix_millis("x_window.start").alias("window_start"), *[f"x_rows{i}" for i in range(len(sides))])
    return closed.mapInArrow(run, ddl)


def stream_window_apply(sdf: DataFrame, ts: str, size_s: int, slide_s: int | None, keys: list[str], inputs: list[str],
                        body: Callable, schema: str, delay_s: int = 0) -> DataFrame:
    """UDF-6 on a stream: ``operators.userfns.window_apply``, each window's body
    run once, when the watermark passes its end."""
    return _bodies([sdf], ts, size_s, slide_s or size_s, keys, [inputs], body, schema, delay_s)


def stream_window_cogroup(left: DataFrame, right: DataFrame, keys: list[str], ts: str, size_s: int,
                          left_inputs: list[str], right_inputs: list[str], body: Callable, schema: str,
                          delay_s: int = 0) -> DataFrame:
    """UDF-9 on streams: ``operators.userfns.window_cogroup`` when the watermark
    of both sides has passed the window's end."""
    return _bodies([left, right], ts, size_s, size_s, keys, [left_inputs, right_inputs], body, schema, delay_s)
