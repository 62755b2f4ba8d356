"""Golden micro-fixtures for the detection operators (hand-computed answers)."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidepool.operators.patterns import (Step, adjacent_pair, cap_per_key, followed_by_within,
                                         jump_alert, match_orders, n_in_a_row, order_verdict,
                                         rising_alert, sequence)

B = datetime(2024, 1, 1)
O = ["ts", "event_id"]


def _ev(spark, rows):
    data = [(i, u, B + timedelta(seconds=s), t, float(v)) for i, (u, s, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, user_id long, ts timestamp, event_type string, value double")


def test_login_fail_pairs(spark):
    df = _ev(spark, [(1, 0, "fail", 0), (1, 1, "fail", 0), (1, 5, "fail", 0), (1, 6, "success", 0),
                     (1, 7, "fail", 0), (2, 0, "fail", 0), (2, 2, "fail", 0)])
    r = adjacent_pair(df, "user_id", O, "ts", "event_type", "fail", "fail", 2).collect()
    # user 1: (0,1) within 2 s; (1,5) too far; success resets; user 2: exactly 2 s is not < 2 s
    assert [(x.user_id, x.first_event_id, x.last_event_id) for x in r] == [(1, 0, 1)]


def test_n_in_a_row(spark):
    df = _ev(spark, [(1, 0, "fail", 0), (1, 1, "fail", 0), (1, 2, "fail", 0), (1, 3, "fail", 0),
                     (1, 4, "ok", 0), (1, 5, "fail", 0), (1, 6, "fail", 0), (1, 30, "fail", 0)])
    r = n_in_a_row(df, "user_id", O, "ts", "event_type", "fail", 3, 10).collect()
    assert sorted((x.first_event_id, x.last_event_id) for x in r) == [(0, 2), (1, 3)]


def test_order_sequence_and_matcher(spark):
    rows = [(1, 0, "create", 0), (1, 100, "pay", 0),      # paid in time
            (2, 0, "create", 0), (2, 1000, "pay", 0),     # paid late
            (3, 0, "create", 0),                           # never paid
            (4, 50, "pay", 0)]                             # pay without create
    df = _ev(spark, rows)
    seq = followed_by_within(df, ["user_id"], O, "ts", "event_type", "create", "pay", 900, ["event_id"])
    assert {x.user_id: x.status for x in seq.collect()} == {1: "matched", 2: "timeout", 3: "timeout"}
    m = match_orders(df, ["user_id"], "ts", "event_type", "create", "pay", 900)
    assert {x.user_id: x.result for x in m.collect()} == {
        1: "payed successfully", 2: "payed but already timeout", 3: "order timeout",
        4: "already payed but not found create log"}
    v = order_verdict(df, ["user_id"], "ts", "event_type", "create", "pay", 900)
    assert {x.user_id: x.result for x in v.collect()} == {
        1: "order payed successfully", 2: "order timeout", 3: "order timeout"}


def test_click_cap(spark):
    df = _ev(spark, [(7, s, "click", 0) for s in range(6)] + [(8, 0, "click", 0)])
    r = cap_per_key(df, ["user_id"], O, 3).collect()
    assert sorted((x.user_id, x.click_no) for x in r) == [(7, 1), (7, 2), (7, 3), (7, 4), (8, 1)]


def test_jump_alert_first_row_never_alerts(spark):
    df = _ev(spark, [(1, 0, "t", 35.8), (1, 1, "t", 350.8), (1, 2, "t", 3500.8), (2, 0, "t", 99)])
    r = jump_alert(df, "user_id", O, "ts", "value", 10).orderBy("event_id").collect()
    assert [(x.prev_value, x.value) for x in r] == [(35.8, 350.8), (350.8, 3500.8)]


def test_rising_alert(spark):
    # user 1: rises from t=1, drop at t=20 (> 1+5) -> alert; user 2: drop at t=3 cancels;
    # user 3: equal values never start a timer
    df = _ev(spark, [(1, 0, "t", 1), (1, 1, "t", 2), (1, 4, "t", 2), (1, 20, "t", 0),
                     (2, 0, "t", 1), (2, 1, "t", 2), (2, 3, "t", 0),
                     (3, 0, "t", 5), (3, 9, "t", 5)])
    r = rising_alert(df, "user_id", O, "ts", "value", 5).collect()
    assert [(x.user_id, x.alert_ms - x.rise_start_ms) for x in r] == [(1, 5000)]


def _attempts(rows, steps, within_s):
    """Brute force of ``sequence``: rows of one key as (id, second, kind); steps as (kind, strict)."""
    out = []
    for i, (rid, t, kind) in enumerate(rows):
        if kind != steps[0][0]:
            continue
        reached, status, at = [rid], "matched", i
        for want, strict in steps[1:]:
            later = rows[at + 1:at + 2] if strict else [r for r in rows[at + 1:] if r[2] == want][:1]
            if not later or later[0][1] - t >= within_s:
                status = "timeout"
            elif later[0][2] != want:
                status = None
            else:
                reached.append(later[0][0])
                at = rows.index(later[0])
                continue
            break
        if status:
            out.append((status, *reached, *[None] * (len(steps) - len(reached))))
    return out


def _random_events(spark, seed, n=400):
    r = random.Random(seed)
    rows = [(i, 0 if r.random() < 0.5 else r.randint(1, 4), B + timedelta(seconds=r.randint(0, 20_000)), r.choice("abcx")) for i in range(n)]
    return rows, spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, kind string")


SEQUENCES = [[("a", False), ("b", False)], [("a", False), ("a", True)], [("a", False), ("b", True), ("c", False)],
             [("a", False), ("b", False), ("c", True), ("a", False)], [("a", False), ("a", True), ("a", True)]]


def test_sequence_equals_brute_force(spark):
    rows, df = _random_events(spark, 5)
    for steps in SEQUENCES:
        made = [Step(f"s{i}", F.col("kind") == k, strict) for i, (k, strict) in enumerate(steps)]
        got = sequence(df, ["user_id"], O, "ts", made, 900, ["event_id"])
        found = sorted(((r.user_id, r.status, *[r[s.name].event_id if r[s.name] else None for s in made]) for r in got.collect()), key=str)
        want = []
        for u in range(5):
            own = sorted(((t, i, k) for i, k0, t, k in rows if k0 == u))
            want += [(u, *a) for a in _attempts([(i, (t - B).total_seconds(), k) for t, i, k in own], steps, 900)]
        assert found == sorted(want, key=str), steps


def test_sequence_reads_and_deals_its_rows_once(spark, tmp_path):
    _, df = _random_events(spark, 6)
    df.write.parquet(str(tmp_path / "e"))
    made = [Step("a", F.col("kind") == "a"), Step("b", F.col("kind") == "b", strict=True), Step("c", F.col("kind") == "c")]
    got = sequence(spark.read.parquet(str(tmp_path / "e")), ["user_id"], O, "ts", made, 900, ["event_id"])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
