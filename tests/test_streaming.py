"""Stream == batch, late data, and the stateful processors."""

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF, new_dir, rows
from tidemark.operators import daily
from tidemark.sources.tables import clickstream
from tidemark.streaming import daily as sdaily
from tidemark.streaming import processors
from tidemark.streaming.runner import run_foreach_batch, run_to_parquet


def _split_events(spark, parts=4):
    """Events in ``parts`` files written one after another, so the file source
    (which orders by modification time) replays them in event order."""
    src = spark.read.parquet(f"{SF}/events.parquet")
    d = new_dir() + "/events"
    n = src.count()
    for i in range(parts):
        (src.where((F.col("event_id") >= i * n // parts) & (F.col("event_id") < (i + 1) * n // parts))
         .coalesce(1).write.mode("append").parquet(d))
        time.sleep(1.1)
    return d, src.schema


def test_daily_stream_equals_batch_multi_batch(spark):
    d, schema = _split_events(spark)
    stream = clickstream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    pv, uv = new_dir() + "/pv", new_dir() + "/uv"
    run_foreach_batch(sdaily.pv_counts(stream, "view"), sdaily.upsert_metric_sink(pv, "pv"), "update")
    run_foreach_batch(sdaily.uv_counts(stream, "view"), sdaily.upsert_metric_sink(pv, "uv"), "update")
    got = rows(sdaily.read_daily(spark, pv), "day", "pv", "uv")
    want = rows(daily.daily_pv_uv(clickstream(spark.read.parquet(f"{SF}/events.parquet")), "view"))
    assert got == want


def _write(d, name, recs):
    pd.DataFrame(recs, columns=["event", "distinct_id", "time_ms"]).to_parquet(os.path.join(d, name))


def test_late_data_rules(spark):
    d = new_dir()
    day_end = 1614528000000  # local midnight (16:00 UTC)
    _write(d, "a.parquet", [("v", "u1", day_end - 60_000)])
    _write(d, "b.parquet", [("v", "u2", day_end + 50_000)])           # watermark -> end - 10 s
    _write(d, "c.parquet", [("v", "u3", day_end - 5_000)])            # within lateness: counted
    _write(d, "d.parquet", [("v", "u4", day_end + 200_000)])          # watermark passes end
    _write(d, "e.parquet", [("v", "u5", day_end + 210_000)])
    _write(d, "f.parquet", [("v", "u6", day_end - 1_000)])            # too late: dropped
    raw = spark.readStream.schema("event string, distinct_id string, time_ms bigint") \
        .option("maxFilesPerTrigger", 1).parquet(d)
    ev = raw.withColumn("ts", F.timestamp_millis("time_ms"))
    pv = new_dir() + "/pv"
    run_foreach_batch(sdaily.pv_counts(ev, "v"), sdaily.upsert_metric_sink(pv, "pv"), "update")
    from tidemark.sinks import snapshot
    got = {r.day: r.value for r in snapshot.read_snapshot(spark, pv).collect()}
    assert got == {"2021-02-28": "2", "2021-03-01": "3"}


def test_alert_processor_stream(spark):
    d = new_dir()
    readings = [("rise", 1, 20.0), ("rise", 5, 21.0), ("rise", 30, 22.0),
                ("fall", 1, 20.0), ("fall", 5, 19.0),
                ("equal", 1, 20.0), ("equal", 5, 20.0),
                ("neg", 1, -1.0), ("neg", 5, -2.0),
                ("zero", 1, -1.0), ("zero", 5, 0.0), ("zero", 7, 1.0)]
    pd.DataFrame(readings, columns=["id", "timestamp", "temperature"]).to_parquet(
        os.path.join(d, "a.parquet"))
    pd.DataFrame([("other", 100, 1.0)], columns=["id", "timestamp", "temperature"]).to_parquet(
        os.path.join(d, "b.parquet"))
    raw = spark.readStream.schema("id string, timestamp bigint, temperature double") \
        .option("maxFilesPerTrigger", 1).parquet(d)
    ev = (raw.withColumn("time_ms", F.col("timestamp") * 1000)
          .withColumn("ts", F.timestamp_seconds("timestamp")).withWatermark("ts", "1 second"))
    out = run_to_parquet(processors.rising_alert_stream(ev, timer_ms=10_000), name="alerts")
    # 'equal' keeps its timer and fires at 11 s when the watermark passes it.
    assert rows(out, "id", "fired_at") == [("equal", 11_000), ("rise", 11_000), ("rise", 40_000)]


def test_keyed_processors_stream(spark):
    d = new_dir()
    pd.DataFrame({"k": [1, 1, 1, 1, 1], "seq": [0, 1, 2, 3, 4], "v": [3, 5, 7, 4, 2]}).to_parquet(
        os.path.join(d, "a.parquet"))
    src = lambda: spark.readStream.schema("k bigint, seq bigint, v bigint").parquet(d)
    pa = run_to_parquet(processors.pair_average_stream(src(), "k", "v", ["seq"]), name="pa")
    assert rows(pa) == [(1, 4), (1, 5)]
    rs = run_to_parquet(processors.running_sum_stream(src(), "k", "v", ["seq"]), name="rs")
    assert rows(rs, "running_sum", "seq") == [(3, 1), (8, 2), (15, 3), (19, 4), (21, 5)]
    cl = run_to_parquet(processors.changelog_stream(src(), "k", ["seq"]), name="cl")
    assert rows(cl, "is_add", "cnt") == sorted([(True, 1), (False, 1), (True, 2), (False, 2), (True, 3),
                                                (False, 3), (True, 4), (False, 4), (True, 5)])


def test_processors_over_batches_equal_batch(spark):
    """Four micro-batches with NULL values and keys: running sums, pair averages
    and the changelog equal their batch forms."""
    from tidemark.operators import keyed
    from tidemark.streaming.runner import replay
    rows_ = [(i % 3 if i % 7 else None, i, None if i % 5 == 0 else i * (2 ** 53 // 97)) for i in range(97)]
    df = spark.createDataFrame(rows_, "k bigint, at bigint, v bigint")
    src = lambda: replay(spark, df, parts=4, at=["at"])
    rs = run_to_parquet(processors.running_sum_stream(src(), "k", "v", ["at"]), name="rs")
    want = keyed.running_totals(df, ["k"], ["at"], "v")
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    both = lambda a, b: sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)
    assert both(rs.select("key", "seq", "running_sum"), want.select("k", "seq", "running_v"))
    pa = run_to_parquet(processors.pair_average_stream(src(), "k", "v", ["at"]), name="pa")
    assert both(pa, keyed.pair_average(df, ["k"], ["at"], "v").select("k", "avg_value"))
    cl = run_to_parquet(processors.changelog_stream(src(), "k", ["at"]), name="cl")
    assert both(cl, keyed.retract_changelog(df, ["k"], ["at"]).select("k", "is_add", "cnt"))


def test_restart_from_checkpoint_exactly_once(spark):
    """A stopped query restarted on the same checkpoint neither loses nor
    repeats input; the keep-max / last-write snapshots stay exact."""
    src = spark.read.parquet(f"{SF}/events.parquet")
    d = new_dir() + "/events"
    n = src.count()
    half = src.where(F.col("event_id") < n // 2)
    half.coalesce(1).write.parquet(d)
    schema = src.schema
    ck, pv = new_dir() + "/ck", new_dir() + "/pv"

    def run():
        s = clickstream(spark.readStream.schema(schema).parquet(d))
        run_foreach_batch(sdaily.pv_counts(s, "view"), sdaily.upsert_metric_sink(pv, "pv"),
                          "update", checkpoint=ck)
    run()
    time.sleep(1.1)
    src.where(F.col("event_id") >= n // 2).coalesce(1).write.mode("append").parquet(d)
    run()   # same checkpoint: only the new file is read
    from tidemark.sinks import snapshot
    got = {r.day: int(r.value) for r in snapshot.read_snapshot(spark, pv).collect()}
    want = {r.day: r.pv for r in daily.daily_pv_uv(clickstream(src), "view").collect()}
    assert got == want


def test_jdbc_stream_sink(spark):
    from tidemark.sources import jdbc
    url = "jdbc:derby:memory:tm_stream;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    d = new_dir()
    pd.DataFrame({"id": ["1", "2"], "ts": [1, 2], "temperature": [1.5, 2.5]}).to_parquet(
        os.path.join(d, "a.parquet"))
    s = spark.readStream.schema("id string, ts bigint, temperature double").parquet(d)
    q = jdbc.stream_to_table(s, url, "sensor_out", new_dir() + "/ck", props)
    q.awaitTermination(120)
    assert jdbc.read_table(spark, url, "sensor_out", props).count() == 2


def test_text_sink_day_buckets(spark):
    from tidemark.sinks import files as file_sinks
    d = new_dir() + "/lines"
    recs = spark.createDataFrame([('{"time":"1614527999000"}',), ('{"time":"x"}',)], "value string")
    file_sinks.write_day_text(file_sinks.with_day_bucket(recs), d)
    back = spark.read.text(d)
    assert rows(back, "dt") == [("2021-02-28",), ("__invalid__",)]


def test_rolling_peak_stream_incremental(spark):
    """Peaks built batch by batch (pane store + ranged re-sweep + keep-max)
    equal the one-shot batch peaks."""
    from tidemark.functions.text import composite_key
    from tidemark.operators import rolling
    from tidemark.sinks import bucketed
    from tidemark.streaming import rolling as srolling
    d, schema = _split_events(spark, parts=4)
    ev = clickstream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    keys = ["message_id", "title"]
    size, slide = 7200, 60
    panes = srolling.distinct_panes(ev, keys, "user_id", "time_us", slide, delay="1 day")
    store, peaks = new_dir() + "/panes", new_dir() + "/peaks"
    run_foreach_batch(panes, srolling.peak_sink(store, peaks, keys, "user_id", size, slide,
                                                composite_key("title", "message_id")), "append")
    got = rows(bucketed.read_table(spark, peaks), "row_key", "uv")
    ev_b = clickstream(spark.read.parquet(f"{SF}/events.parquet"))
    seg = rolling.rolling_distinct_segments(ev_b, keys, "user_id", "time_us", size, slide)
    want = rows(rolling.peak_distinct(seg, keys).select(
        composite_key("title", "message_id").alias("row_key"), "uv"))
    assert got == want
    # Days behind the watermark are gone from the pane store.
    kept = spark.read.parquet(store).agg(F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert kept.hi - kept.lo <= 2 * 86400 // slide


def test_start_daily_jobs(spark):
    base = new_dir() + "/daily"
    ev = clickstream(spark.readStream.schema(spark.read.parquet(f"{SF}/events.parquet").schema)
                     .option("basePath", SF).parquet(f"{SF}/events.parque[t]"))
    qs = sdaily.start_daily_jobs(sdaily.guarded(ev), base, pv_event="view", live_event="click",
                                 trigger={"availableNow": True})
    for q in qs:
        assert q.awaitTermination(300)
    got = sdaily.read_daily(spark, base + "/daily")
    b = clickstream(spark.read.parquet(f"{SF}/events.parquet"))
    want = daily.daily_pv_uv(b, "view").join(daily.daily_live(b, "click"), "day", "full_outer")
    assert rows(got, "day", "pv", "uv", "live_users", "live_avg") == \
        rows(want, "day", "pv", "uv", "live_users", "live_avg")


def test_future_clamp_stream_equals_batch(spark):
    from tidemark.operators.guard import guard_future_clamp
    d, schema = _split_events(spark, parts=3)
    now = 1704067200000 + 3 * 86_400_000   # events after day 3 (+10 min) are "future" here
    stream = clickstream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    src = stream.select("event_id", "time_ms", F.pmod("user_id", F.lit(3)).alias("src"))
    got = run_to_parquet(processors.future_clamp_stream(src, "src", "time_ms", "event_id",
                                                        "event_id", 600_000, now), name="clamp")
    batch = clickstream(spark.read.parquet(f"{SF}/events.parquet")).select(
        "event_id", "time_ms", F.pmod("user_id", F.lit(3)).alias("src"))
    want = guard_future_clamp(batch, "time_ms", now, ["src"], ["event_id"])
    assert rows(got, "id", "guarded_time") == rows(want, "event_id", "guarded_time")


def test_processing_time_window_count(spark):
    from tidemark.operators import windows
    d, schema = _split_events(spark, parts=2)
    s = clickstream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    arr = windows.with_arrival_time(s).withWatermark("arrival", "0 seconds")
    counts = windows.keyed_window_count(arr, ["event"], "5 seconds", time_col="arrival")
    out = new_dir() + "/pt"
    def write(b, i):
        b.write.mode("overwrite").parquet(f"{out}/batch={i}")
    run_foreach_batch(counts, write, "update")
    got = spark.read.parquet(out).groupBy("event", "window_end").agg(F.max("n").alias("n"))
    total = got.agg(F.sum("n")).first()[0]
    assert total == spark.read.parquet(f"{SF}/events.parquet").count()


def test_day_json_stream_sink(spark):
    """K1 on a stream: file sink under dt=<local day>/, exactly once per batch."""
    from tidemark.sinks import files as file_sinks
    d, schema = _split_events(spark, parts=2)
    ev = clickstream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    recs = ev.select("event", "distinct_id", F.col("time_ms").alias("time")) \
        .withColumn("dt", file_sinks.day_bucket(F.col("time").cast("string")))
    out = new_dir() + "/days"
    q = file_sinks.day_json_stream(recs, out, new_dir() + "/ck")
    assert q.awaitTermination(300)
    back = spark.read.schema("event STRING, distinct_id STRING, time BIGINT, dt STRING").json(out)
    got = rows(back.groupBy("dt").count())
    want = rows(daily.daily_pv_uv(
        clickstream(spark.read.parquet(f"{SF}/events.parquet")).withColumn("event", F.lit("x")),
        "x").select("day", "pv"))
    assert got == want


def test_hot_items_stream_report(spark):
    from tidemark.operators import hot_items
    from tidemark.streaming import hot_items as shot
    d, schema = _split_events(spark, parts=2)
    ev = clickstream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d))
    out = new_dir() + "/reports"
    run_foreach_batch(shot.window_counts(ev, behavior="view"), shot.top_n_sink(out, with_report=True),
                      "append")
    got = rows(spark.read.parquet(out).select("window_end", "report"))
    b = clickstream(spark.read.parquet(f"{SF}/events.parquet"))
    max_ms = b.agg(F.max("time_ms")).first()[0]
    want = hot_items.report(hot_items.hot_items(b, behavior="view")).where(
        F.col("window_end") <= max_ms)
    assert got == rows(want, "window_end", "report") and len(got) > 0


def test_raw_json_lines_to_daily_snapshots(spark):
    """The README flow: raw JSON records -> parse -> Entry-1 streaming jobs."""
    from tidemark.functions.json import parse_events
    src = clickstream(spark.read.parquet(f"{SF}/events.parquet"))
    d = new_dir()
    name = (F.when(F.col("event") == "view", "$AppStart").when(F.col("event") == "click", "LiveVisit")
            .otherwise(F.col("event")))
    src.select(F.to_json(F.struct(name.alias("event"), "distinct_id",
                                  F.col("time_ms").alias("time"))).alias("value")).write.text(d + "/in")
    ev = (parse_events(spark.readStream.text(d + "/in"), "value")
          .withColumn("ts", F.timestamp_millis("time")).withColumn("time_ms", F.col("time")))
    for q in sdaily.start_daily_jobs(sdaily.guarded(ev), d + "/daily", pv_event="$AppStart",
                                     live_event="LiveVisit", trigger={"availableNow": True}):
        assert q.awaitTermination(300)
    cols = ("day", "pv", "uv", "live_users", "live_avg")
    want = daily.daily_pv_uv(src, "view").join(daily.daily_live(src, "click"), "day", "full_outer")
    assert rows(sdaily.read_daily(spark, d + "/daily/daily"), *cols) == rows(want, *cols)
