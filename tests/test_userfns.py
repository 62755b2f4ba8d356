"""User functions: partial states, window and co-group bodies, rich maps; batch and stream."""

import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidepool.operators.userfns import (Aggregate, map_with_setup, partial_states, reduce_aggregate,
                                        user_aggregate, window_apply, window_cogroup,
                                        window_user_aggregate)
from tidepool.streaming.runner import read_staged, run_append, scratch
from tidepool.streaming.stateful import flat_map_with_state
from tidepool.streaming.userfns import stream_window_apply, stream_window_user_aggregate

B = datetime(2024, 1, 1)
# order of merging must not matter to a caller's aggregate; this one keeps a sorted list of the three largest
TOP3 = Aggregate(list, lambda s, r: sorted([*s, r[0]], reverse=True)[:3] if r[0] is not None else s,
                 lambda a, b: sorted(a + b, reverse=True)[:3], lambda s: (len(s), s), "n long, top array<double>")


def _rows(seed=1, n=600):
    r = random.Random(seed)
    return [(i, None if i % 50 == 7 else "hot" if r.random() < 0.6 else f"k{r.randint(0, 5)}", B + timedelta(seconds=r.randint(0, 7200)) if i % 41 else None,
             None if i % 13 == 0 else float(r.randint(0, 1000))) for i in range(n)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(_rows(), "id long, k string, ts timestamp, v double").repartition(6)


def _top3(values):
    best = sorted((v for v in values if v is not None), reverse=True)[:3]
    return len(best), best


def test_user_aggregate(df):
    want = defaultdict(list)
    for _, k, _, v in _rows():
        want[k].append(v)
    got = {r.k: (r.n, r.top) for r in user_aggregate(df, ["k"], ["v"], TOP3).collect()}
    assert got == {k: _top3(v) for k, v in want.items()}


def test_hot_keys_are_combined_before_the_shuffle(df):
    states = partial_states(df, ["k"], ["v"], TOP3)
    per_key = {r.k: r["count"] for r in states.groupBy("k").count().collect()}
    assert per_key["hot"] <= 6  # one state a task, not one a row


def test_states_held_by_a_task_are_bounded(df, monkeypatch):
    import tidepool.operators.userfns as u

    monkeypatch.setattr(u, "HELD", 2)
    got = {r.k: (r.n, r.top) for r in user_aggregate(df, ["k"], ["v"], TOP3).collect()}
    assert got["hot"] == _top3([v for _, k, _, v in _rows() if k == "hot"]) and len(got) == 8


@pytest.mark.parametrize("slide", [None, 120, 420])
def test_user_aggregate_in_windows(df, slide):
    size, step = 600, slide or 600
    want = defaultdict(list)
    for _, k, t, v in _rows():
        if t is not None:
            s = int((t - datetime(1970, 1, 1)).total_seconds())
            at = s // step * step
            while at > s - size:
                want[k, at].append(v)
                at -= step
    got = {(r.k, r.window_start // 1000): (r.n, r.top) for r in window_user_aggregate(df, "ts", size, slide, ["k"], ["v"], TOP3).collect()}
    assert got == {k: _top3(v) for k, v in want.items()}


def test_user_reduce_and_empty_table(df):
    longest = reduce_aggregate(lambda a, b: max(a, b), "id long")
    got = {r.k: r.id for r in user_aggregate(df, ["k"], ["id"], longest).collect()}
    assert got["hot"] == max(i for i, k, _, _ in _rows() if k == "hot")
    assert user_aggregate(df.limit(0), ["k"], ["id"], longest).count() == 0
    assert window_user_aggregate(df.limit(0), "ts", 60, None, ["k"], ["v"], TOP3).count() == 0


def test_window_body_streams_its_rows(df):
    def body(key, window, rows):
        first = next(rows)
        yield key[0], window[1] - window[0], 1 + sum(1 for _ in rows), first[0] is not None

    got = window_apply(df, "ts", 3600, None, ["k"], ["id"], body, "key string, length long, n long, has boolean").collect()
    assert sum(r.n for r in got) == sum(t is not None for _, _, t, _ in _rows())
    assert all(r.length == 3_600_000 and r.has and r.key == r.k for r in got)


def test_cogroup_calls_windows_of_either_side(df):
    left, right = df.where("id % 2 = 0 AND k <> 'k1'"), df.where("id % 2 = 1 AND k <> 'k2'")
    got = window_cogroup(left, right, ["k"], "ts", 3600, ["id"], ["id", "v"], lambda k, w, a, b: [(len(list(a)), len(list(b)))], "a long, b long").collect()
    want = defaultdict(lambda: [0, 0])
    for i, k, t, _ in _rows():
        if t is not None and k is not None and k != ("k1" if i % 2 == 0 else "k2"):
            want[k, int((t - B).total_seconds()) // 3600][i % 2] += 1
    base = int((B - datetime(1970, 1, 1)).total_seconds()) // 3600
    assert {(r.k, r.window_start // 3_600_000 - base): [r.a, r.b] for r in got} == dict(want)


def test_rich_map_closes_its_resource(spark, tmp_path):
    log = str(tmp_path / "log")

    def note(word):
        with open(log, "a") as f:
            f.write(word + "\n")

    def fail(resource, row):
        if row[0] == 5:
            raise ValueError("bad row")
        yield from [(row[0] * resource,)] * (row[0] % 3)

    out = map_with_setup(spark.range(4).coalesce(1), lambda: note("open") or 10, fail, lambda r: note("close"), "v long")
    assert sorted(r.v for r in out.collect()) == [10, 20, 20]
    assert open(log).read().split() == ["open", "close"]
    with pytest.raises(Exception, match="bad row"):
        map_with_setup(spark.range(9).coalesce(1), lambda: note("open") or 1, fail, lambda r: note("close"), "v long").collect()
    words = open(log).read().split()
    assert words.count("open") == words.count("close") >= 2


# --- streams ------------------------------------------------------------------------------
def _stage(spark, base, rows):
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double")
    df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return df.schema


def _feed(spark, name, make, parts):
    """The query is stopped and started again after every part."""
    base = scratch(spark, name)
    for rows in parts:
        schema = _stage(spark, base, rows)
        run_append(make(read_staged(spark, f"{base}/in", schema)), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")


EVENTS = [(i, i % 2, B + timedelta(seconds=3 * i), float((7 * i) % 20)) for i in range(100)]
END = [(900, -1, B + timedelta(days=5), None), (901, -1, B + timedelta(days=9), None)]


def test_windows_survive_restarts_and_close_once(spark):
    agg = lambda sdf: stream_window_user_aggregate(sdf, "ts", 60, 30, ["user_id"], ["value"], TOP3)
    got = sorted((r.user_id, r.window_start, r.n, r.top) for r in _feed(spark, "uagg", agg, [EVENTS[:33], EVENTS[33:70], EVENTS[70:] + END[:1], END[1:]])
                 .where("user_id >= 0").collect())
    want = window_user_aggregate(spark.createDataFrame(EVENTS, "event_id long, user_id long, ts timestamp, value double"), "ts", 60, 30, ["user_id"], ["value"], TOP3)
    assert got == sorted((r.user_id, r.window_start, r.n, r.top) for r in want.collect())


def test_rows_beyond_the_watermark_open_no_window_again(spark):
    body = lambda key, window, rows: [(sum(1 for _ in rows),)]
    make = lambda sdf: stream_window_apply(sdf, "ts", 60, None, ["user_id"], ["event_id"], body, "n long", delay_s=10)
    late = [(500, 0, B + timedelta(seconds=1), 1.0)]
    parts = [EVENTS[:50], EVENTS[50:], EVENTS[-1:], late, END[:1], END[1:]]
    got = _feed(spark, "ubody", make, parts).where("user_id >= 0").collect()
    assert len(got) == len({(r.user_id, r.window_start) for r in got})
    first = int((B - datetime(1970, 1, 1)).total_seconds()) * 1000
    assert {(r.user_id, r.n) for r in got if r.window_start == first} == {(0, 10), (1, 10)}


def test_flat_map_state_comes_back_and_can_be_cleared(spark):
    """Runs of equal values: emitted with their length when the value changes; a -1 clears the state."""
    def runs(row, state):
        if row.value == -1.0:
            return [("cleared", 0)], None
        if state is None or state[0] != row.value:
            return ([] if state is None else [(str(state[0]), state[1])]), (row.value, 1)
        return [], (state[0], state[1] + 1)

    make = lambda sdf: flat_map_with_state(sdf, "user_id", "ts", "event_id", {"value": "double"}, runs,
                                           "value double, n long", "kind string, n long")
    values = [5, 5, 5, 2, 2, -1, 2, 3]
    rows = [(i, 1, B + timedelta(seconds=i), float(v)) for i, v in enumerate(values)]
    got = _feed(spark, "flat", make, [rows[:2], rows[2:5], rows[5:]])
    assert sorted((r.kind, r.n) for r in got.collect()) == [("2.0", 1), ("5.0", 3), ("cleared", 0)]
    assert got.columns == ["user_id", "kind", "n"]


def test_window_bodies_on_streams_call_python_by_batch_not_by_window(spark):
    """Keys without a value, late rows, several windows of a key in a batch, a body that leaves rows."""
    base = scratch(spark, "bodies")
    rows = [(i, None if i % 7 == 0 else i % 90, B + timedelta(seconds=(i * 977) % 7200), None if i % 5 == 0 else i / 2) for i in range(600)]
    for k, part in enumerate((rows[:300], rows[300:], [(-1, -1, B + timedelta(days=9), None)])):
        spark.createDataFrame(part, "id long, k long, ts timestamp, v double").coalesce(1).write.mode("append").parquet(f"{base}/in")
        time.sleep(0.05)

    def body(key, window, rows):
        first = next(rows)
        yield (1 if first[0] is None else 2,)
        if key[0] != 5:
            yield (100 + sum(1 for _ in rows),)

    sdf = read_staged(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema)
    out = stream_window_apply(sdf, "ts", 600, None, ["k"], ["v", "id"], body, "n long", delay_s=7200)
    run_append(out, f"{base}/out", f"{base}/ckpt")
    got, want = defaultdict(list), defaultdict(int)
    for r in spark.read.parquet(f"{base}/out").collect():
        got[r.k, r.window_start // 1000, r.window_end // 1000].append(r.n)
    for _, k, t, _ in rows:
        s = int((t - datetime(1970, 1, 1)).total_seconds()) // 600 * 600
        want[k, s, s + 600] += 1
    assert set(got) == set(want)
    for (k, *w), n in want.items():
        told = sorted(got[k, *w])
        assert told[0] in (1, 2) and told[1:] == ([] if k == 5 else [99 + n])
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "TransformWithState" not in plan


def test_cogroups_on_streams_see_windows_of_either_side(spark):
    from tidepool.streaming.userfns import stream_window_cogroup

    base = scratch(spark, "cogroup")
    rows = [(i, i % 40, B + timedelta(seconds=(i * 977) % 7200)) for i in range(400)]
    sides = []
    for side in (0, 1):
        for part in ([r for r in rows if r[0] % 3 % 2 == side], [(-1, -1, B + timedelta(days=9))]):
            spark.createDataFrame(part, "id long, k long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{base}/in{side}")
            time.sleep(0.05)
        sides.append(read_staged(spark, f"{base}/in{side}", spark.read.parquet(f"{base}/in{side}").schema))
    out = stream_window_cogroup(*sides, ["k"], "ts", 600, ["id"], ["id"], lambda key, window, a, b: [(sum(1 for _ in b), sum(1 for _ in a))], "b long, a long")
    run_append(out, f"{base}/out", f"{base}/ckpt")
    want = defaultdict(lambda: [0, 0])
    for i, k, t in rows:
        want[k, int((t - datetime(1970, 1, 1)).total_seconds()) // 600][i % 3 % 2] += 1
    assert {(r.k, r.window_start // 600_000): [r.a, r.b] for r in spark.read.parquet(f"{base}/out").collect()} == dict(want)
    assert "TransformWithState" not in out._jdf.queryExecution().analyzed().toString()


def test_state_has_a_partition_for_cores_not_for_each_of_the_session_shuffles(spark):
    base, before = scratch(spark, "state_partitions"), spark.conf.get("spark.sql.shuffle.partitions")
    rows = [(i, i % 30, B + timedelta(seconds=(i * 977) % 7200)) for i in range(300)]
    for part in (rows, [(-1, -1, B + timedelta(days=9))]):
        spark.createDataFrame(part, "id long, k long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{base}/in")
        time.sleep(0.05)

    def run():
        sdf = read_staged(spark, f"{base}/in", spark.read.parquet(f"{base}/in").schema)
        out = stream_window_apply(sdf, "ts", 600, None, ["k"], ["id"], lambda key, window, mine: [(sum(1 for _ in mine),)], "n long")
        return run_append(out, f"{base}/out", f"{base}/ckpt")

    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        first = {op["numShufflePartitions"] for p in run() for op in p["stateOperators"]}
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
        spark.createDataFrame([(-2, -2, B + timedelta(days=30))], "id long, k long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{base}/in")
        spark.conf.set("spark.sql.shuffle.partitions", 3)  # a resumed stream keeps its own
        again = {op["numShufflePartitions"] for p in run() for op in p["stateOperators"]}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == again == {2 * spark.sparkContext.defaultParallelism}
    want = defaultdict(int)
    for _, k, t in [*rows, (-1, -1, B + timedelta(days=9))]:
        want[k, int((t - datetime(1970, 1, 1)).total_seconds()) // 600] += 1
    assert {(r.k, r.window_start // 600_000): r.n for r in spark.read.parquet(f"{base}/out").collect()} == dict(want)
