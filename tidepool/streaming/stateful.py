"""Event-ordered keyed state machines on streams (PAT-1..9, count windows, ...).

Keys are dealt to buckets by their hash. Spark calls Python once for a bucket
and batch, not once for a key, which would cost milliseconds for a row or two;
a bucket's keys are one value of state and have one event-time timer.

Within a micro-batch the rows of a key arrive unordered and may be late by up
to the watermark delay. With a delay, ``OrderedKeyProcessor`` buffers rows in
list state, and the timer fires when the watermark passes the oldest; the
buffered rows older than the watermark are released, by key and sorted by
``(ts_us, id)``, through ``step`` — a small per-row function over a carried
state. With delay 0 (ascending event time) no row older than the watermark can
arrive later, so each batch is sorted and stepped directly (equal timestamps
split across batches are taken in arrival order). State survives restarts with
the query checkpoint. NULLs arrive as None (a NaN counts as NULL).

``flat_map_with_state`` is the same for a caller's own function, ``sequence_stream``
for patterns of steps.
"""

from __future__ import annotations

from collections import deque, namedtuple
from collections.abc import Callable, Iterator
from decimal import Decimal
from itertools import groupby
from math import fsum
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidepool.operators.patterns import Step

SLICE = 10_000  # rows that are Python objects at the same time
BUCKETS = 4096  # of keys that share a state
WHOLE = ("bigint", "long", "int", "smallint", "tinyint")


def column_values(column: pd.Series, kind: str) -> list:
    """A column's values; NULL as None, whole numbers as int."""
    if column.dtype.kind != "f":
        return column.tolist()
    whole = kind in WHOLE
    return [None if v != v else int(v) if whole else v for v in column.tolist()]


class OrderedKeyProcessor(StatefulProcessor):
    """Subclasses define ``row_fields`` (DDL of buffered payload after
    ``ts_us bigint, id bigint``), ``carry_schema`` (DDL), ``out_columns`` and
    ``step(key, carry, row) -> (carry, [output tuples])``. ``load`` and ``save``
    turn the stored tuple into the working state and back, once per batch."""

    row_fields = ""
    carry_schema = ""
    out_columns: list[str] = []

    # Set by run_ordered: buffer rows until the watermark passes them (delay > 0),
    # or process each micro-batch directly (delay 0: event time ascends, no row
    # older than the watermark can arrive later); the types of the key's columns;
    # the columns of a bucket's state.
    buffered = True
    key_kinds: list[str] = []
    stored: pa.Schema | None = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # all keys of the bucket as an Arrow stream; its timer; time of the oldest waiting row
        self.state = handle.getValueState("state", "kept binary, armed_ms bigint, oldest_us bigint")
        if self.buffered:
            self.pending = handle.getListState("pending", "rows binary")  # an Arrow stream a batch
        fields = ["ts_us bigint", "id bigint"] + self.row_fields.split(",")
        self.cols = [tuple(f.split()[:2]) for f in fields]

    def load(self, saved):
        return saved

    def save(self, carry):
        return carry

    def step(self, key, carry, row):
        raise NotImplementedError

    def on_watermark(self, key, carry, wm_us: int):
        """Called with the watermark once every row older than it has been
        stepped: emit what time alone decides (timeouts). Returns ``(carry, outputs)``."""
        return carry, []

    def deadline_us(self, carry) -> int | None:
        """Event time at which ``on_watermark`` must run even without new rows."""
        return None

    def _opened(self) -> tuple[dict, int | None, int | None]:
        """The bucket's keys, each with its stored state and deadline; the timer
        that is set; the time of the oldest waiting row."""
        if not self.state.exists():
            return {}, None, None
        kept, armed, oldest = self.state.get()
        n = len(self.key_kinds)
        rows = zip(*(c.to_pylist() for c in pa.ipc.open_stream(bytes(kept)).read_all().columns))
        return {r[:n]: (r[n + 1:], r[n]) for r in rows}, armed, oldest

    def _keep(self, held: dict, key, carry) -> None:
        saved = None if carry is None else self.save(carry)
        if saved is None:
            held.pop(key, None)
        else:
            held[key] = tuple(saved), self.deadline_us(carry)

    def _closed(self, held: dict, armed: int | None, oldest: int | None) -> None:
        """Store the state; one timer, for the first deadline or waiting row,
        replaces the one that was set."""
        times = [due for _, due in held.values() if due is not None] + ([] if oldest is None else [oldest])
        due = min(times) // 1000 + 1 if times else None
        if held or oldest is not None:
            self.state.update((_stream([(*key, at, *saved) for key, (saved, at) in held.items()], self.stored), due, oldest))
        else:
            self.state.clear()
        if due != armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            if due is not None:
                self.handle.registerTimer(due)

    def _frame(self, out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=self.out_columns, dtype=object)  # None stays None, whole numbers exact

    def _in_order(self, every: pd.DataFrame) -> Iterator[tuple[tuple, tuple]]:
        """(key, row) by key, time and id, made ``SLICE`` at a time."""
        by = [every["id"].to_numpy(), every["ts_us"].to_numpy()]
        for i in range(len(self.key_kinds)):
            by += [pd.factorize(every[f"x_key{i}"])[0], every[f"x_null{i}"].to_numpy()]
        every = every.iloc[np.lexsort(by)]
        for lo in range(0, len(every), SLICE):
            part = every.iloc[lo:lo + SLICE]
            keys = [[None if none else v for v, none in zip(column_values(part[f"x_key{i}"], kind), part[f"x_null{i}"].tolist())]
                    for i, kind in enumerate(self.key_kinds)]
            yield from zip(zip(*keys), zip(*(column_values(part[c], kind) for c, kind in self.cols)))

    def _stepped(self, held: dict, every: pd.DataFrame, wm_us: int | None) -> Iterator[list]:
        """Step all rows, key by key; results, some thousand at a time. With a
        watermark, first what it decides for a key that has rows."""
        out: list = []
        for key, rows in groupby(self._in_order(every), itemgetter(0)):
            carry = self.load(held[key][0] if key in held else None)
            if wm_us is not None:
                carry, emitted = self.on_watermark(key, carry, wm_us)
                out.extend(emitted)
            for _, row in rows:
                carry, emitted = self.step(key, carry, row)
                out.extend(emitted)
                if len(out) >= SLICE:
                    yield out
                    out = []
            self._keep(held, key, carry)
        if out:
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows), ignore_index=True)
        held, armed, oldest = self._opened()
        if self.buffered:
            columns = [c for c in every.columns if c not in ("x_bucket", "x_ts")]
            self.pending.appendValue((_stream(every[columns]),))
            # the timer fires when the oldest row is older than the watermark; all
            # rows that are then get released (in order)
            first = every["ts_us"].min()
            oldest = min(t for t in (oldest, 0 if first != first else int(first)) if t is not None)
        else:
            for out in self._stepped(held, every, timerValues.getCurrentWatermarkInMs() * 1000):
                yield self._frame(out)
        self._closed(held, armed, oldest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        held, _, oldest = self._opened()
        if oldest is not None and oldest < wm_us:
            every = pd.concat([pa.ipc.open_stream(bytes(b)).read_all().to_pandas() for (b,) in self.pending.get()], ignore_index=True)
            waits = (every["ts_us"] >= wm_us).to_numpy()
            keep = every[waits]
            if len(keep):
                self.pending.put([(_stream(keep),)])
            else:
                self.pending.clear()
            oldest = int(keep["ts_us"].min()) if len(keep) else None
            for out in self._stepped(held, every[~waits], None):
                yield self._frame(out)
        out = []
        for k in [k for k, (_, due) in held.items() if due is not None and due < wm_us]:
            carry, emitted = self.on_watermark(k, self.load(held[k][0]), wm_us)
            out.extend(emitted)
            self._keep(held, k, carry)
        if out:
            yield self._frame(out)
        self._closed(held, None, oldest)  # the timer that fired is gone

    def close(self) -> None:
        pass


def _stream(rows: list | pd.DataFrame, schema: pa.Schema | None = None) -> bytes:
    """Rows as an Arrow stream."""
    if schema is None:
        batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    else:
        columns = zip(*rows) if rows else [()] * len(schema)
        batch = pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, schema.types)], schema=schema)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as to:
        to.write_batch(batch)
    return sink.getvalue().to_pybytes()


class FlatMapProcessor(OrderedKeyProcessor):
    """UDF-8: a caller's ``fn(row, state) -> (rows, state)``. ``row`` is a named
    tuple of ``ts_us``, ``id`` and the payload; ``state`` is None at first and
    whenever the function returned None, else a tuple of ``state_schema``."""

    def __init__(self, fn: Callable, row_fields: str, state_schema: str, out_columns: list[str]):
        self.fn, self.row_fields, self.carry_schema, self.out_columns = fn, row_fields, state_schema, out_columns
        self.names = ["ts_us", "id", *[f.split()[0] for f in row_fields.split(",")]]

    def init(self, handle):
        super().init(handle)
        self.row = namedtuple("row", self.names)

    def step(self, key, carry, row):
        rows, carry = self.fn(self.row(*row), carry)
        return carry, [(*key, *r) for r in rows]


def flat_map_with_state(sdf: DataFrame, key, ts: str, id_col: str, payload: dict[str, str], fn: Callable,
                        state_schema: str, out_fields: str, delay_s: int = 0) -> DataFrame:
    """UDF-8: rows of each key, in event order, through ``fn(row, state) -> (rows, state)``.

    ``payload``: columns that the function sees, with their types; ``out_fields``:
    DDL of a row that it returns, to which the key's columns are added.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kinds = dict(sdf.dtypes)
    out_names = [f.split()[0] for f in out_fields.split(",")]
    processor = FlatMapProcessor(fn, ", ".join(f"{c} {t}" for c, t in payload.items()), state_schema, keys + out_names)
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + [out_fields])
    return run_ordered(sdf, keys, ts, id_col, list(payload), processor, schema, delay_s)


def jump(threshold: float) -> Callable:
    """PAT-8 as a flat map: ``|value - previous| > threshold``; a NULL neither alerts nor is compared with."""
    def fn(row, state):
        before = state[0] if state is not None else None
        hit = before is not None and row.value is not None and abs(row.value - before) > threshold
        return ([(row.id, before, row.value)] if hit else []), (row.value,)

    return fn


class SequenceProcessor(OrderedKeyProcessor):
    """PAT-2 / UDF-10: ``operators.patterns.sequence`` on a stream.

    ``waiting[i]``: the attempts that wait for step i, oldest first. A row that
    fits moves all of them on together; where it doesn't, those that wait for a
    strict step are given up. An attempt is moved once per step, never copied.
    """

    carry_schema = "lengths array<int>, ids array<bigint>, times array<bigint>"

    def __init__(self, keys: list[str], strict: list[bool], within_s: int):
        self.strict, self.within_us, n = strict, within_s * 1_000_000, len(strict)
        self.row_fields = ", ".join(f"fits_{i} boolean" for i in range(n))
        self.out_columns = [*keys, "status", *[f"{c}_{i}" for i in range(n) for c in ("id", "us")]]

    def load(self, saved):
        waiting = [deque() for _ in self.strict]
        if saved is not None:
            lengths, ids, times = saved
            at = 0
            for n in lengths:
                waiting[n].append(list(zip(ids[at:at + n], times[at:at + n])))
                at += n
        return waiting

    def save(self, waiting):
        attempts = [a for part in waiting for a in part]
        if not attempts:
            return None
        return [len(a) for a in attempts], [i for a in attempts for i, _ in a], [t for a in attempts for _, t in a]

    def _row(self, key, status, attempt):
        reached = [x for pair in attempt for x in pair]
        return (*key, status, *reached, *[None] * (2 * len(self.strict) - len(reached)))

    def _timeouts(self, key, waiting, now_us):
        out = []
        for part in waiting:
            while part and part[0][0][1] + self.within_us <= now_us:
                out.append(self._row(key, "timeout", part.popleft()))
        return out

    def step(self, key, waiting, row):
        ts_us, rid, fits = row[0], row[1], row[2:]
        out = self._timeouts(key, waiting, ts_us)
        for i in range(len(self.strict) - 1, 0, -1):
            if fits[i]:
                for attempt in waiting[i]:
                    attempt.append((rid, ts_us))
                if i == len(self.strict) - 1:
                    out.extend(self._row(key, "matched", a) for a in waiting[i])
                else:
                    waiting[i + 1].extend(waiting[i])
                waiting[i] = deque()
            elif self.strict[i]:
                waiting[i].clear()
        if fits[0]:
            waiting[1].append([(rid, ts_us)])
        return waiting, out

    def on_watermark(self, key, waiting, wm_us):
        return waiting, self._timeouts(key, waiting, wm_us)

    def deadline_us(self, waiting):
        return min((part[0][0][1] + self.within_us for part in waiting if part), default=None)


def sequence_stream(sdf: DataFrame, key, ts: str, id_col: str, steps: list[Step], within_s: int, delay_s: int = 0) -> DataFrame:
    """Attempts as ``operators.patterns.sequence`` gives them: keys, ``status``
    and a struct (id_col, ``us``: epoch µs) per step. Timeouts are emitted when
    the watermark passes the attempt's time limit."""
    keys = [key] if isinstance(key, str) else list(key)
    kinds = dict(sdf.dtypes)
    marked = sdf.select("*", *[F.coalesce(s.where, F.lit(False)).alias(f"fits_{i}") for i, s in enumerate(steps)])
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "status string",
                        *[f"{c}_{i} bigint" for i in range(len(steps)) for c in ("id", "us")]])
    out = run_ordered(marked, keys, ts, id_col, [f"fits_{i}" for i in range(len(steps))],
                      SequenceProcessor(keys, [s.strict for s in steps], within_s), schema, delay_s)
    return out.select(*keys, "status", *[
        F.when(F.col(f"id_{i}").isNotNull(), F.struct(F.col(f"id_{i}").alias(id_col), F.col(f"us_{i}").alias("us"))).alias(s.name)
        for i, s in enumerate(steps)])


def matched_span(found: DataFrame, key: str, first: str, last: str, id_col: str = "event_id") -> DataFrame:
    """Matched attempts of ``sequence_stream`` as first and last event."""
    return found.where("status = 'matched'").select(
        key, F.col(f"{first}.{id_col}").alias("first_event_id"), F.col(f"{last}.{id_col}").alias("last_event_id"),
        F.floor(F.col(f"{first}.us") / 1000).cast("bigint").alias("first_fail_ms"),
        F.floor(F.col(f"{last}.us") / 1000).cast("bigint").alias("last_fail_ms"))


class ClickCapProcessor(OrderedKeyProcessor):
    """PAT-7: per key (user, item) and UTC day pass the first ``cap`` rows, warn once at
    ``cap + 1``; the counter resets when the day changes and is forgotten when the
    watermark has passed its day."""

    row_fields = "day_ms bigint"
    carry_schema = "day_ms bigint, n bigint"
    out_columns = ["user_id", "item_id", "event_id", "day_ms", "click_no", "kind"]

    def __init__(self, cap: int):
        self.cap = cap

    def step(self, key, carry, row):
        _, rid, day = row
        n = carry[1] + 1 if carry is not None and carry[0] == day else 1
        out = []
        if n <= self.cap:
            out.append((*key, rid, day, n, "pass"))
        elif n == self.cap + 1:
            out.append((*key, rid, day, n, "warn"))
        return (day, n), out

    def on_watermark(self, key, carry, wm_us):
        return (None if carry is not None and self.deadline_us(carry) <= wm_us else carry), []

    def deadline_us(self, carry):
        return (carry[0] + 86_400_000) * 1000


class RisingProcessor(OrderedKeyProcessor):
    """PAT-9: after the first rise of a run (no drop since), alert once when
    event time passes first rise + duration without a drop at or before it."""

    row_fields = "value double"
    # last value, deadline of the armed timer (or NULL), first rise time, alerted in this run
    carry_schema = "value double, deadline bigint, rise bigint, alerted boolean"
    out_columns = ["user_id", "rise_start_ms", "alert_ms"]

    def __init__(self, duration_s: int):
        self.d_us = duration_s * 1_000_000

    def _fire(self, key, carry):
        v, deadline, rise, _ = carry
        return (v, None, rise, True), [(key[0], rise // 1000, deadline // 1000)]

    def step(self, key, carry, row):
        ts_us, _, v = row
        out = []
        if carry is not None and carry[1] is not None and ts_us > carry[1]:
            carry, out = self._fire(key, carry)
        if v is None:                               # neither a rise nor a drop
            return (None, *(carry[1:] if carry is not None else (None, None, False))), out
        if carry is None or carry[0] is None or v < carry[0]:  # first row, after a NULL or a drop: new run
            return (v, None, None, False), out
        if v > carry[0] and carry[1] is None and not carry[3]:
            return (v, ts_us + self.d_us, ts_us, False), out
        return (v, carry[1], carry[2], carry[3]), out

    def on_watermark(self, key, carry, wm_us):
        if carry is not None and carry[1] is not None and carry[1] < wm_us:
            return self._fire(key, carry)
        return carry, []

    def deadline_us(self, carry):
        return carry[1]


class CountWindowProcessor(OrderedKeyProcessor):
    """WIN-12: every ``n`` rows of a key emit the min of ``value``; reset."""

    row_fields = "value double"
    carry_schema = "n bigint, window_no bigint, mn double"
    out_columns = ["user_id", "window_no", "min_value"]

    def __init__(self, n: int):
        self.n = n

    def step(self, key, carry, row):
        _, _, v = row
        n, w, mn = carry if carry is not None else (0, 0, None)
        n, mn = n + 1, v if mn is None else mn if v is None else min(mn, v)
        if n == self.n:
            return (0, w + 1, None), [(key[0], w + 1, mn)]
        return (n, w, mn), []


class SlidingCountProcessor(OrderedKeyProcessor):
    """WIN-13: every ``slide`` rows, the sum of the last ``size`` values
    (the carry holds at most ``size`` values: bounded state)."""

    row_fields = "value double"
    carry_schema = "row_no bigint, last array<double>"
    out_columns = ["user_id", "row_no", "sum_value"]

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def step(self, key, carry, row):
        _, _, v = row
        rn, last = carry if carry is not None else (0, [])
        rn, last = rn + 1, (list(last) + [v])[-self.size:]
        known = [x for x in last if x is not None]
        out = [(key[0], rn, fsum(known) if known else None)] if rn % self.slide == 0 else []
        return (rn, last), out


class EveryNthProcessor(OrderedKeyProcessor):
    """WIN-15: emit every ``n``-th row of a key."""

    row_fields = "value double"
    carry_schema = "row_no bigint"
    out_columns = ["user_id", "event_id", "row_no"]

    def __init__(self, n: int):
        self.n = n

    def step(self, key, carry, row):
        _, rid, _ = row
        rn = (carry[0] if carry is not None else 0) + 1
        return (rn,), ([(key[0], rid, rn)] if rn % self.n == 0 else [])


class RollingReduceProcessor(OrderedKeyProcessor):
    """AGG-6: first row unchanged, then ``(prev.ts + step, cur.value + bump)``."""

    row_fields = "value double"
    carry_schema = "ts_s bigint"
    out_columns = ["user_id", "event_id", "reduced_ts_s", "reduced_value"]

    def __init__(self, step_s: int = 1, bump: float = 10.0):
        self.step_s, self.bump = step_s, bump

    def step(self, key, carry, row):
        ts_us, rid, v = row
        if carry is None:
            ts_s = ts_us // 1_000_000
            return (ts_s,), [(key[0], rid, ts_s, v)]
        ts_s = carry[0] + self.step_s
        return (ts_s,), [(key[0], rid, ts_s, None if v is None else v + self.bump)]


class RunningSumProcessor(OrderedKeyProcessor):
    """AGG-7: running sum per key on every row, exact in the decimal digits of
    the values; NULL adds nothing."""

    row_fields = "value double"
    carry_schema = "total string"
    out_columns = ["user_id", "event_id", "running_sum"]

    def step(self, key, carry, row):
        _, rid, v = row
        total = Decimal(carry[0]) if carry is not None else Decimal(0)
        if v is not None:
            total += Decimal(repr(v))
        return (str(total),), [(key[0], rid, float(total))]


class WindowRunningCountProcessor(OrderedKeyProcessor):
    """WIN-8: inside each (key, sliding window) number the rows 1..n in event order.

    State is one count per window of the key that is still open, at most
    ``size / slide``; rows are not copied to their windows before the shuffle."""

    row_fields = "value double"
    carry_schema = "starts array<bigint>, counts array<bigint>"
    out_columns = ["user_id", "window_start", "event_id", "window_end", "running_count"]

    def __init__(self, size_s: int, slide_s: int):
        self.size_us, self.slide_us = size_s * 1_000_000, slide_s * 1_000_000

    def load(self, saved):
        return dict(zip(*saved)) if saved is not None else {}

    def save(self, counts):
        return (list(counts), list(counts.values())) if counts else None

    def _open(self, counts, now_us):
        for start in [s for s in counts if s + self.size_us <= now_us]:
            del counts[start]

    def step(self, key, counts, row):
        ts_us, rid = row[0], row[1]
        self._open(counts, ts_us)
        out, start = [], ts_us - ts_us % self.slide_us
        while start > ts_us - self.size_us:
            counts[start] = n = counts.get(start, 0) + 1
            out.append((key[0], start // 1000, rid, (start + self.size_us) // 1000, n))
            start -= self.slide_us
        return counts, out

    def on_watermark(self, key, counts, wm_us):
        """A window that the watermark has passed gets no more rows: forget it."""
        self._open(counts, wm_us)
        return counts, []

    def deadline_us(self, counts):
        return max(counts) + self.size_us if counts else None


class CumulativeWindowProcessor(OrderedKeyProcessor):
    """AGG-10: per key, the count of each tumbling window and the total over
    all its windows so far (never reset). A window is emitted when a row of a
    later window arrives or when the watermark passes its end."""

    row_fields = "value double"
    carry_schema = "win_start bigint, cnt bigint, before bigint"
    out_columns = ["user_id", "window_end", "cnt", "cumulative"]

    def __init__(self, size_s: int):
        self.size_us = size_s * 1_000_000

    def _emit(self, key, carry):
        start, cnt, before = carry
        return (None, 0, before + cnt), [(key[0], (start + self.size_us) // 1000, cnt, before + cnt)]

    def step(self, key, carry, row):
        ts_us = row[0]
        start = ts_us - ts_us % self.size_us
        out = []
        if carry is not None and carry[0] is not None and carry[0] != start:
            carry, out = self._emit(key, carry)
        before = carry[2] if carry is not None else 0
        cnt = carry[1] + 1 if carry is not None and carry[0] == start else 1
        return (start, cnt, before), out

    def on_watermark(self, key, carry, wm_us):
        if carry is not None and carry[0] is not None and carry[0] + self.size_us < wm_us:
            return self._emit(key, carry)
        return carry, []

    def deadline_us(self, carry):
        return carry[0] + self.size_us if carry[0] is not None else None


def run_ordered(sdf: DataFrame, key, ts: str, id_col: str, payload: list[str],
                processor: OrderedKeyProcessor, out_schema: str, delay_s: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """Apply an ``OrderedKeyProcessor`` per ``key`` (a column or a list of
    columns) with event-time timers. Keys are dealt to ``buckets`` by their hash,
    and a bucket's keys share a state, a timer and a Python call per batch. The
    number belongs to the checkpoint; it should grow with the number of keys
    that are open at a time, to some hundred or thousand a bucket."""
    keys = [key] if isinstance(key, str) else list(key)
    kinds = dict(sdf.dtypes)
    processor.buffered = delay_s > 0
    processor.key_kinds = [kinds[k] for k in keys]
    processor.stored = to_arrow_schema(StructType.fromDDL(", ".join(
        [*[f"x_key{i} {kind}" for i, kind in enumerate(processor.key_kinds)], "x_due bigint", processor.carry_schema])))
    # whole numbers without NULLs stay whole in pandas
    parts = [c for i, k in enumerate(keys) for c in (
        (F.coalesce(k, F.lit(0).cast(kinds[k])) if kinds[k] in WHOLE else F.col(k)).alias(f"x_key{i}"), F.col(k).isNull().alias(f"x_null{i}"))]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    src = (sdf.withWatermark(ts, f"{int(delay_s)} seconds")
              .select(bucket.alias("x_bucket"), *parts, F.unix_micros(ts).alias("ts_us"), F.col(id_col).alias("id"),
                      *payload, F.col(ts).alias("x_ts")))
    return (src.groupBy("x_bucket")
               .transformWithStateInPandas(statefulProcessor=processor,
                                           outputStructType=out_schema,
                                           outputMode="Append", timeMode="EventTime"))
