"""Early results by event time, event order over triggers, clamped watermarks, expiring state."""

import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, new_dir, rows
from tidemark.operators import keyed
from tidemark.sources.tables import clickstream
from tidemark.streaming import early, expiring, ordered, processors
from tidemark.streaming.runner import replay, run_foreach_batch, run_processing_time, run_to_parquet, state_partitions

DAY_END = 1614528000000          # local midnight (16:00 UTC)


def _files(recs, columns):
    """One file a list of records, in order; returns the folder."""
    d = new_dir()
    for i, part in enumerate(recs):
        _add(d, i, part, columns)
    return d


def _add(d, i, part, columns):
    path = os.path.join(d, f"{i:03}.parquet")
    pd.DataFrame(part, columns=columns).to_parquet(path)
    os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))


def _ticks(spark, d, checkpoint, path, **kw):
    raw = spark.readStream.schema("event string, distinct_id string, time_ms bigint").option("maxFilesPerTrigger", 1).parquet(d)
    ev = raw.withColumn("ts", F.timestamp_millis("time_ms"))
    run_foreach_batch(early.tick_increments(ev, "v", **kw), early.totals_sink(path), "append", checkpoint=checkpoint)
    return rows(early.read_ticks(spark, path), "tick", "pv", "uv")


def _uncommit(checkpoint):
    """As if the run had died after its sink wrote: the last batch is run again."""
    last = max(int(x) for x in os.listdir(checkpoint + "/commits") if x.isdigit())
    os.remove(f"{checkpoint}/commits/{last}")
    os.remove(f"{checkpoint}/commits/.{last}.crc")


COLS = ["event", "distinct_id", "time_ms"]


def test_ticks_and_close(spark):
    """Totals at each tick with new events, whatever the order of the rows within the bound; other
    events and users without a name; the close."""
    t = DAY_END - 600_000
    d = _files([[("v", "a", t + 1), ("v", "b", t + 20_000), ("x", "c", t + 3)],
                [("v", "a", t + 4_999), ("v", "a", t + 5_000), ("v", None, t + 21_000)],     # earlier than the file before
                [("x", "z", DAY_END + 3_600_000)], [("x", "z", DAY_END + 3_700_000)]], COLS)
    got = _ticks(spark, d, new_dir() + "/ck", new_dir() + "/t")
    assert got == [(t + 5_000, 2, 1), (t + 10_000, 3, 1), (t + 25_000, 5, 2), (DAY_END, 5, 2)]


def test_late_rows_count_at_the_next_tick(spark):
    """A row behind its pane counts at the next tick; one after the close in the close's new row; one
    after the lateness not at all."""
    t = DAY_END - 3_600_000
    d = _files([[("v", "a", t)], [("v", "b", t + 100_000)], [("x", "", t + 100_001)],
                [("v", "c", t + 1)],                                            # 100 s late
                [("x", "", DAY_END + 45_000)], [("x", "", DAY_END + 45_001)],  # the day has closed
                [("v", "d", t + 2)],                                            # within the lateness
                [("x", "", DAY_END + 61_000)], [("x", "", DAY_END + 61_001)], [("x", "", DAY_END + 61_002)],
                [("v", "e", t + 3)], [("x", "", DAY_END + 90_000)]], COLS)
    got = _ticks(spark, d, new_dir() + "/ck", new_dir() + "/t", buckets=2)
    assert got == [(t + 5_000, 1, 1), (t + 75_000, 2, 2), (t + 105_000, 3, 3), (DAY_END, 4, 4)]


def test_ticks_survive_a_restart_and_a_repeated_batch(spark):
    rng = random.Random(4)
    t = DAY_END - 7_200_000
    recs = sorted(("v", f"u{rng.randint(0, 30)}", t + rng.randint(0, 7_100_000)) for _ in range(300))
    recs.sort(key=lambda r: r[2] + rng.randint(0, 25_000))
    parts = [recs[:100], recs[100:180], recs[180:], [("x", "", DAY_END + 3_600_000)], [("x", "", DAY_END + 3_600_001)]]
    want = _ticks(spark, _files(parts, COLS), new_dir() + "/ck", new_dir() + "/t")
    d, ck, path = _files(parts[:2], COLS), new_dir() + "/ck", new_dir() + "/t"
    _ticks(spark, d, ck, path)
    _uncommit(ck)
    for i, part in enumerate(parts[2:]):
        _add(d, i + 2, part, COLS)
    assert _ticks(spark, d, ck, path) == want
    by_tick, users = {}, set()
    for _, u, ms in sorted(recs, key=lambda r: r[2]):
        users.add(u)
        by_tick[ms // 5000 * 5000 + 5000] = (sum(r[2] // 5000 <= ms // 5000 for r in recs), len(users))
    by_tick.setdefault(DAY_END, max(by_tick.values()))
    assert want == sorted((k, *v) for k, v in by_tick.items())


def _shuffled(spark, n=400, keys=4, seed=2):
    rng = random.Random(seed)
    recs = [(i, f"k{min(rng.randint(0, keys), keys - 1)}" if i % 17 else None, 1_600_000_000_000_000 + i * 700_000 + rng.randint(0, 400_000),
             None if i % 23 == 0 else float(rng.randint(-3, 9))) for i in range(n)]
    df = spark.createDataFrame(recs, "event_id bigint, k string, us bigint, v double")
    df = df.withColumn("ts", F.timestamp_micros("us"))
    end = df.agg(F.max("us").alias("us")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit("end").alias("k"), (F.col("us") + 60_001_000).alias("us"),
        F.lit(0.0).alias("v"), F.timestamp_micros(F.col("us") + 60_001_000).alias("ts"))
    at = df.withColumn("_at", F.col("us") + F.pmod(F.col("event_id") * 7919, F.lit(60)) * 1_000_000)
    return df, lambda: replay(spark, at, [end], parts=6, at=["_at", "event_id"]).withWatermark("ts", "60 seconds")


def _same(got, want):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@pytest.mark.parametrize("slot_ms, inline", [(10_000, 3), (3_600_000, 4_096)])
def test_alerts_in_event_order(spark, slot_ms, inline):
    """Rows shuffled over triggers within the bound: the batch alerts."""
    df, stream = _shuffled(spark)
    got = run_to_parquet(ordered.rising_alerts(stream(), "k", "us", ["event_id"], "v", timer_ms=3_000, unit_ms=1, slot_ms=slot_ms, inline=inline))
    want = keyed.rising_alerts(df.withColumn("t", F.floor(F.col("us") / 1000).cast("bigint")), "k", "t", ["us", "event_id"], "v", 3_000)
    assert want.count() > 5
    _same(got.select("fired_at", "alert"), want.select("fired_at", "alert"))


def test_keyed_functions_in_event_order(spark):
    df, stream = _shuffled(spark, seed=3)
    df = df.withColumn("c", F.col("v").cast("bigint"))
    _same(run_to_parquet(ordered.running_sums(stream().withColumn("c", F.col("v").cast("bigint")), "k", "us", ["event_id"], "c")),
          keyed.running_totals(df, ["k"], ["us", "event_id"], "c").select("k", "running_c", "seq"))
    _same(run_to_parquet(ordered.pair_averages(stream().withColumn("c", F.col("v").cast("bigint")), "k", "us", ["event_id"], "c")),
          keyed.pair_average(df, ["k"], ["us", "event_id"], "c").select("k", "avg_value"))
    _same(run_to_parquet(ordered.changelog(stream(), "k", "us", ["event_id"])),
          keyed.retract_changelog(df, ["k"], ["us", "event_id"]).select("k", "is_add", "cnt"))


def test_calls_to_the_state_do_not_grow_with_keys(spark, tmp_path):
    """Keys share a bucket's state, null and negative whole numbers too: its rows are bounded by the buckets."""
    df = spark.range(8_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 4_000 != 7, (F.col("id") % 4_000) - 2 ** 60).alias("k"),
                                   (F.lit(1_600_000_000_000_000) + F.pmod(F.col("id") * 7919, F.lit(8_000)) * 1_000).alias("us")).withColumn(
        "ts", F.timestamp_micros("us"))
    end = spark.sql("select -1L event_id, -1L k, 1600000100000000L us").withColumn("ts", F.timestamp_micros("us"))
    stream = replay(spark, df, [end], parts=2, at=["event_id"]).withWatermark("ts", "10 seconds")
    out = ordered.in_event_order(stream, ordered.SumFold(), "k", "us", ["event_id"], F.col("event_id"))
    with state_partitions(spark, 2):
        q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    # A bucket's values, head and timer, which is indexed twice.
    assert 0 < max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]) <= 4 * ordered.BUCKETS + 4
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    _same(got, keyed.running_totals(df, ["k"], ["us", "event_id"], "event_id").select("k", "running_event_id", "seq"))


def test_hot_key_in_many_files(spark):
    """One key with most of the rows: its rows wait in slots, each trigger is a share of the files."""
    df = spark.range(20_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 10 != 0, "hot").otherwise("cold").alias("k"),
                                    (F.lit(1_600_000_000_000_000) + F.col("id") * 50_000).alias("us")).withColumn(
        "ts", F.timestamp_micros("us"))
    end = spark.sql("select -1L event_id, 'end' k, 1600001000000000L + 61000000L us").withColumn("ts", F.timestamp_micros("us"))
    stream = replay(spark, df, [end], parts=8, at=["event_id"]).withWatermark("ts", "60 seconds")
    got = run_to_parquet(ordered.in_event_order(stream, ordered.SumFold(), "k", "us", ["event_id"], F.col("event_id"), slot_ms=10_000, inline=500))
    _same(got, keyed.running_totals(df, ["k"], ["event_id"], "event_id").select("k", "running_event_id", "seq"))


def test_replay_by_size(spark, monkeypatch):
    """Files and what a trigger takes follow the bytes, late rows too; nothing is one file because it is late."""
    from tidemark.streaming import runner
    df = spark.range(4_000).select("id", F.col("id").alias("at"))
    monkeypatch.setattr(runner, "FILE_BYTES", 4_000)
    stream = replay(spark, df, [df], parts=4, at=["at"])
    sizes = []

    def write(batch, batch_id):
        sizes.append((batch.count(), batch.agg(F.max("at")).first()[0]))

    run_foreach_batch(stream, write, "append")
    sizes = [s for s in sizes if s[0]]
    assert sum(n for n, _ in sizes) == 8_000 and len(sizes) >= 4 and max(n for n, _ in sizes) < 2_000
    half = len(sizes) // 2
    assert [t for _, t in sizes[:half]] == sorted(t for _, t in sizes[:half])


def test_clamp_then_watermark_over_a_restart(spark):
    """A future row takes its source's largest time before; it moves no watermark; the query goes on after a stop."""
    t, now = DAY_END - 3_600_000, DAY_END + 86_400_000
    cols = ["event", "distinct_id", "time_ms", "offset", "src"]
    parts = [[("v", "a", t, 0, 0), ("v", "b", now * 2, 1, 0), ("v", "c", t + 9, 2, 1)],
             [("v", "d", t + 7_000, 3, 0), ("v", "e", now * 2, 4, 1), ("v", "a", now * 3, 5, 2)],
             [("x", "", DAY_END + 3_600_000, 6, 0)], [("x", "", DAY_END + 3_600_001, 7, 0)]]
    d, ck, path = _files(parts[:1], cols), new_dir() + "/ck", new_dir() + "/t"

    def run():
        raw = spark.readStream.schema("event string, distinct_id string, time_ms bigint, offset bigint, src bigint").option(
            "maxFilesPerTrigger", 1).parquet(d)
        clamped = processors.future_clamp_stream(raw, "src", "time_ms", "offset", "offset", 600_000, now, carry=["event", "distinct_id"])
        timed = clamped.withColumn("ts", F.timestamp_millis("guarded_time"))
        run_foreach_batch(early.tick_increments(timed, "v"), early.totals_sink(path), "append", checkpoint=ck)

    run()
    for i, part in enumerate(parts[1:]):
        _add(d, i + 1, part, cols)
    run()
    # The row of source 2 has no time before it and counts in 1970, which the watermark closed long ago.
    assert rows(early.read_ticks(spark, path), "tick", "pv", "uv") == [
        (t + 5_000, 4, 4), (t + 10_000, 5, 5), (DAY_END, 5, 5)]


def test_state_expires_over_a_restart(spark):
    """Counts begin anew when their state has not been written for its time to live, also after a restart."""
    d, ck, seen = _files([[("v", "a", DAY_END), ("v", "a", DAY_END + 1), ("v", "b", DAY_END + 2)]], COLS), new_dir() + "/ck", []

    def run(ttl_ms):
        raw = spark.readStream.schema("event string, distinct_id string, time_ms bigint").parquet(d)
        ev = raw.withColumn("ts", F.timestamp_millis("time_ms"))
        run_processing_time(expiring.expiring_counts(ev, "v", ttl_ms=ttl_ms, buckets=1),
                            lambda b, i: seen.extend(rows(b, "day", "pv", "uv")), "update", checkpoint=ck)
        return seen[-1]

    assert run(15_000) == ("2021-03-01", 3, 2)
    _add(d, 1, [("v", "a", DAY_END + 3), ("v", "c", DAY_END + 4)], COLS)
    assert run(15_000) == ("2021-03-01", 5, 3)          # within the time: it goes on
    time.sleep(16)
    _add(d, 2, [("v", "a", DAY_END + 5)], COLS)
    assert run(15_000) == ("2021-03-01", 1, 1)          # expired: never returned


def test_word_counts_follow_the_changelog(spark):
    """Stream word counts after a restart in the middle and a repeated batch equal the batch ones."""
    from tidemark.operators import words
    from tidemark.sinks import bucketed
    from tidemark.streaming import changes
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    d, ck, path = new_dir() + "/in", new_dir() + "/ck", new_dir() + "/t"

    def run():
        s = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", 1).parquet(d)
        run_foreach_batch(changes.count_changes(words.tokens(s), "word"), changes.table_sink(path, "word", 8), "update", checkpoint=ck)

    docs.where("doc_id % 2 = 0").repartition(2).write.parquet(d)
    run()
    _uncommit(ck)
    docs.where("doc_id % 2 = 1").coalesce(1).write.mode("append").parquet(d)
    run()
    assert rows(bucketed.read_table(spark, path), "word", "cnt") == rows(words.word_count(docs), "word", "n")
