"""Rolling distinct sweep vs window(), hot items, daily windows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import daily, hot_items, rolling
from tidemark.sources.tables import clickstream


def test_sweep_equals_window_count_distinct(spark):
    rnd = random.Random(3)
    base = datetime(2024, 1, 1)
    data = [(rnd.choice("ab"), rnd.randrange(12), base + timedelta(seconds=rnd.randrange(7200)))
            for _ in range(400)]
    df = spark.createDataFrame(data, "k string, u int, ts timestamp").withColumn(
        "us", F.unix_micros("ts"))
    size, slide = 600, 60
    seg = rolling.rolling_distinct_segments(df, ["k"], "u", "us", size, slide)
    got = rows(rolling.expand_segments(seg, ["k"], size, slide), "k", "win_start", "uv")
    ref = (df.groupBy("k", F.window("ts", f"{size} seconds", f"{slide} seconds").alias("w"))
           .agg(F.count_distinct("u").alias("uv"))
           .select("k", F.unix_seconds("w.start").alias("s"), "uv"))
    assert got == rows(ref, "k", "s", "uv")
    peak = rows(rolling.peak_distinct(seg, ["k"]))
    assert peak == rows(ref.groupBy("k").agg(F.max("uv")))


def test_hot_items_ties_and_report(spark):
    t = datetime(2024, 1, 1, 0, 1)
    data = [("pv", 1, t), ("pv", 2, t), ("pv", 3, t), ("pv", 3, t), ("pv", 4, t), ("buy", 9, t)]
    df = spark.createDataFrame(data, "event string, item_id bigint, ts timestamp")
    top = hot_items.hot_items(df, n=3)
    one = top.where(F.col("window_end") == 1704070800000)
    assert rows(one, "rank", "item_id", "view_count") == [(1, 3, 2), (2, 1, 1), (3, 2, 1)]
    rep = hot_items.report(one).first().report
    assert rep.startswith("=" * 36 + "\n时间: 2024-01-01 09:00:00.0\nNo0:  商品ID=3  浏览量=2\n")
    assert rep.endswith("No2:  商品ID=2  浏览量=1\n" + "=" * 36 + "\n\n")


def test_daily_split_at_local_midnight(spark):
    df = spark.createDataFrame([("$AppStart", "u1", 1614527999000), ("$AppStart", "u1", 1614528000000),
                                ("$AppStart", "u2", 1614528000001)],
                               "event string, distinct_id string, time_ms bigint")
    df = df.withColumn("ts", F.timestamp_millis("time_ms"))
    assert rows(daily.daily_pv_uv(df)) == [("2021-02-28", 1, 1), ("2021-03-01", 2, 2)]


def test_clickstream_mapping(spark):
    ev = clickstream(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    r = ev.first()
    assert r.title == "room-" + r.message_id and r.time_us // 1000 == r.time_ms


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(slide=st.sampled_from([30, 60, 300]), k=st.integers(1, 6),
       events=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 7), st.integers(0, 5000)),
                       min_size=1, max_size=60))
def test_sweep_property(spark, slide, k, events):
    base = datetime(2024, 1, 1)
    data = [(key, u, base + timedelta(seconds=s)) for key, u, s in events]
    df = spark.createDataFrame(data, "k string, u int, ts timestamp").withColumn(
        "us", F.unix_micros("ts"))
    size = slide * k
    seg = rolling.rolling_distinct_segments(df, ["k"], "u", "us", size, slide)
    got = rows(rolling.expand_segments(seg, ["k"], size, slide), "k", "win_start", "uv")
    ref = (df.groupBy("k", F.window("ts", f"{size} seconds", f"{slide} seconds").alias("w"))
           .agg(F.count_distinct("u").alias("uv"))
           .select("k", F.unix_seconds("w.start").alias("s"), "uv"))
    assert got == rows(ref, "k", "s", "uv")


def test_sweep_over_stretches(spark, monkeypatch):
    """Runs of equal counts do not depend on how long a stretch is, over gaps, before 1970 and with NULL keys;
    no task sums up more than one stretch."""
    import random

    from tidemark.operators import rolling
    rng = random.Random(8)
    recs = [(rng.choice(["a", None]), rng.randint(0, 6), rng.choice([-90, 0, 500]) * 1_000_000 + rng.randint(0, 80) * 1_000_000)
            for _ in range(300)]
    df = spark.createDataFrame(recs, "k string, u int, us bigint")
    got = {}
    for stretch in (1, 3, 1000):
        monkeypatch.setattr(rolling, "STRETCH", stretch)
        seg = rolling.rolling_distinct_segments(df, ["k"], "u", "us", 12, 2)
        got[stretch] = sorted(map(tuple, rolling.expand_segments(seg, ["k"], 12, 2).select("k", "win_start", "uv").collect()), key=str)
    want = {}
    for k, u, us in recs:
        for i in range(6):
            want.setdefault((k, (us // 2_000_000 - i) * 2), set()).add(u)
    assert got[1] == got[3] == got[1000] == sorted(((*key, len(v)) for key, v in want.items()), key=str)
