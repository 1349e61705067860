"""Keyed sequence, pair average, running sum, changelog and alert fold."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import keyed
from tidemark.operators.guard import guard_future_clamp
from tidemark.operators.sequence import keyed_running


def test_pair_average_golden(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([3, 5, 7, 4, 2])],
                               "k bigint, seq bigint, v bigint")
    out = keyed.pair_average(df, ["k"], ["seq"], "v")
    assert rows(out, "k", "avg_value") == [(1, 4), (1, 5)]


def test_running_sum_golden(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("b", 2, 3), ("b", 3, 5)],
                               "k string, seq bigint, v bigint")
    out = keyed.running_totals(df, ["k"], ["seq"], "v")
    assert rows(out, "k", "running_v") == [("a", 1), ("a", 3), ("b", 3), ("b", 8)]


def test_keyed_running_hot_key_matches_window(spark):
    rnd = random.Random(7)
    data = []
    for i in range(6000):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(50)}"
        data.append((k, rnd.randrange(1000), i, rnd.choice([None, rnd.randrange(-50, 100)])))
    df = spark.createDataFrame(data, "k string, t bigint, id bigint, v bigint")
    got = keyed_running(df, ["k"], ["t", "id"], sums=["v"], maxes=["v"], partitions=16)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn"),
                    F.sum(F.coalesce("v", F.lit(0))).over(w).alias("rs"),
                    F.max("v").over(w).alias("rm"))
    j = got.join(ref, "id")
    assert j.count() == 6000
    bad = j.where((F.col("seq") != F.col("rn")) | (F.col("running_v") != F.col("rs")) |
                  ~F.col("running_max_v").eqNullSafe(F.col("rm")))
    assert bad.count() == 0


def test_changelog_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, t bigint")
    out = keyed.retract_changelog(df, ["k"], ["t"])
    assert rows(out, "k", "change_seq", "is_add", "cnt") == [
        ("a", 1, True, 1), ("a", 2, False, 1), ("a", 3, True, 2), ("b", 1, True, 1)]


ALERT_CASES = {
    # sensor: readings (t seconds, value) -> alerts (FIXTURES.md §7, per-key firing)
    "rise": ([(1, 20.0), (5, 21.0), (30, 22.0)], [11]),
    "fall": ([(1, 20.0), (5, 19.0), (30, 19.0)], []),
    "equal": ([(1, 20.0), (5, 20.0), (30, 20.0)], [11]),
    "negative": ([(1, -1.0), (5, -2.0)], []),
    "zero_prev": ([(1, -1.0), (5, 0.0), (7, 1.0), (30, 1.0)], []),
}


def test_rising_alert_batch(spark):
    data = [(s, t, i, v) for s, (rs, _) in ALERT_CASES.items() for i, (t, v) in enumerate(rs)]
    df = spark.createDataFrame(data, "id string, t bigint, n bigint, v double")
    out = keyed.rising_alerts(df, "id", "t", "n", "v", timer_s=10)
    want = sorted((s, a) for s, (_, al) in ALERT_CASES.items() for a in al)
    assert rows(out, "id", "fired_at") == want
    assert out.where("id = 'rise'").first().alert == "rise温度连续上升"


def test_future_guard_clamp(spark):
    now = 1_000_000
    df = spark.createDataFrame([(0, 1, 900_000), (0, 2, now + 700_000), (0, 3, 950_000),
                                (1, 4, now + 900_000), (1, 5, 10)],
                               "src int, off bigint, t bigint")
    out = guard_future_clamp(df, "t", now, ["src"], ["off"])
    assert rows(out, "off", "guarded_time") == [(1, 900_000), (2, 900_000), (3, 950_000),
                                                (4, 0), (5, 10)]


def plain_alerts(data, timer):
    """The alert rule over (key, t, n, value) rows, one reading at a time."""
    readings = sorted(((k, t, n, v) for k, t, n, v in data if v is not None and not math.isnan(v)),
                      key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    end, state, out = max(r[1] for r in readings), {}, []
    for k, t, _, v in readings:
        last, due = state.get(k, (0.0, 0))
        after, fired = keyed.alert_step(last, due, t, v, timer)
        if fired:
            out.append((k, due))
        state[k] = (v, after)
    out += [(k, due) for k, (_, due) in state.items() if 0 < due <= end]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def got_alerts(df, timer):
    out = keyed.rising_alerts(df, "id", "t", "n", "v", timer_s=timer).collect()
    return sorted(((r.id, r.fired_at) for r in out), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def test_rising_alert_hot_key_null_and_nan(spark):
    """A hot key over many ranges, with NULL and NaN values, exact zeros and a NULL key."""
    rnd = random.Random(11)
    data = []
    for i in range(3000):
        k = "hot" if rnd.random() < 0.5 else rnd.choice([None, *[f"s{j}" for j in range(8)]])
        v = rnd.choice([0.0, -1.0, None, math.nan, float(rnd.randrange(-3, 6))])
        data.append((k, rnd.randrange(2000), i, v))
    df = spark.createDataFrame(data, "id string, t bigint, n bigint, v double")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        want = plain_alerts(data, 7)
        assert got_alerts(df, 7) == want and len(want) > 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_rising_alert_long_monotonic(spark):
    """One sensor, strictly rising readings: every timer fires and re-arms."""
    rnd = random.Random(5)
    t, data = 0, []
    for i in range(1500):
        t += rnd.choice([1, 2, 3])
        data.append(("hot", t, i, float(i + 1)))
    df = spark.createDataFrame(data, "id string, t bigint, n bigint, v double")
    want = plain_alerts(data, 7)
    assert got_alerts(df, 7) == want and len(want) > 200


def test_keyed_running_null_key_long_and_decimal(spark):
    """More rows of a NULL key than an Arrow batch holds, numbers near 2^60, decimals."""
    big = 2 ** 60
    df = spark.range(0, 30000, 1, 2).selectExpr(
        "cast(null as bigint) as k", "id", f"if(id % 7 = 0, null, {big} + id) as m",
        "if(id % 5 = 0, null, id + 1000000000001) as s", "cast(id as decimal(20, 2)) as d")
    out = keyed_running(df, ["k"], ["id"], sums=["s", "d"], maxes=["m"], lags=["s"], partitions=1).collect()
    out = sorted(out, key=lambda r: r.id)
    total = dec = 0
    top = prev = None
    for i, r in enumerate(out):
        total += r.s or 0
        dec += r.d
        top = max(x for x in (top, r.m) if x is not None) if r.m is not None or top is not None else None
        assert (r.seq, r.running_s, r.running_d, r.running_max_m, r.prev_s) == (i + 1, total, dec, top, prev)
        prev = r.s
    wide = sorted(keyed_running(df, ["k"], ["id"], sums=["s"], maxes=["m"], lags=["s"], partitions=7).collect(), key=lambda r: r.id)
    assert [(r.seq, r.running_s, r.running_max_m, r.prev_s) for r in wide] == [
        (r.seq, r.running_s, r.running_max_m, r.prev_s) for r in out]


def test_null_summand_counts_as_zero(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([3, None, 7, 9])], "k bigint, seq bigint, v bigint")
    assert rows(keyed.pair_average(df, ["k"], ["seq"], "v"), "avg_value") == [(1,), (8,)]


def test_future_guard_keeps_missing_time_missing(spark):
    df = spark.createDataFrame([(0, 1, 900), (0, 2, None)], "src int, off bigint, t bigint")
    out = guard_future_clamp(df, "t", 1000, ["src"], ["off"])
    assert {r.off: r.guarded_time for r in out.collect()} == {1: 900, 2: None}
