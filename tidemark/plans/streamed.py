"""Streaming twins: the same answers computed by Structured Streaming queries.

Each twin replays a driver table as a file stream of several micro-batches in
time order, runs to completion with ``availableNow`` (fresh checkpoints under
the shared checkpoint folder), writes through the real sinks and returns what
the sinks hold.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.plans.batch import ALERT_SQL, ALERT_TIMER_S, HOT_ITEMS_SQL, LIVE_EVENT, LOCAL_DAY_SQL, PV_EVENT
from tidemark.functions.text import composite_key
from tidemark.operators import words
from tidemark.plans.registry import register
from tidemark.session import shared_dir
from tidemark.sinks import bucketed, snapshot
from tidemark.sources.tables import clickstream, read_table
from tidemark.streaming import daily as sdaily
from tidemark.streaming import changes, early, expiring, lookup, ordered, processors
from tidemark.streaming import hot_items as shot
from tidemark.streaming import rolling as srolling
from tidemark.streaming.runner import (replay, run_foreach_batch, run_foreach_batches, run_processing_time,
                                      run_to_parquet)


# Rows derived from each event whose id ends so: one without a time, one far in the future.
NO_TIME, FUTURE = 7, 13
FUTURE_TS = "2300-01-01 00:00:00"


def _timed(spark: SparkSession, sf_dir: str):
    """Events in several files by time, with derived rows that must not count:
    rows without a time or in the future among them, and in a last file copies of old rows
    that arrive after the watermark has closed their days."""
    ev = read_table(spark, sf_dir, "events")
    at = ev.withColumn("_at", F.col("ts"))
    bad = at.where(F.col("event_id") % 50 == NO_TIME).withColumn("ts", F.lit(None).cast("timestamp_ntz")).unionByName(
        at.where(F.col("event_id") % 50 == FUTURE).withColumn("ts", F.lit(FUTURE_TS).cast("timestamp_ntz")))
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    # Spark drops what is behind the watermark of the trigger before, so take the oldest fifth.
    late = ev.where(F.col("ts") < F.lit(first + (last - first) / 5)) if first else ev
    return clickstream(replay(spark, at.unionByName(bad), [late], at=("_at", "event_id")))


def _end_row(ev, after: str):
    """A finite input ends: one row so long after the last event, which counts nothing."""
    return ev.agg(F.max("ts").alias("ts")).where(F.col("ts").isNotNull()).select(
        F.lit(-1).cast("bigint").alias("event_id"), (F.col("ts") + F.expr(f"interval {after}")).alias("ts"),
        F.lit(-1).cast("bigint").alias("user_id"), F.lit("end").alias("event_type"),
        F.lit(0.0).alias("value"), F.lit("{}").alias("props")).select(*ev.columns)


def _daily(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """The daily jobs of ``names`` over one input into one table; returns its path."""
    jobs = [j for j in sdaily.daily_jobs(sdaily.guarded(_timed(spark, sf_dir)), PV_EVENT, LIVE_EVENT) if j[0] in names]
    path = shared_dir(spark, "daily-metrics")
    run_foreach_batches([(df, sdaily.upsert_metric_sink(path, column, name), "update", name) for name, df, column in jobs])
    return path


@register("daily_pv_uv_stream", covers="X1 X5 X7 X8 K4 A6 A7", oracle=f"""
select {LOCAL_DAY_SQL} as day, count(*) as pv, count(distinct user_id) as uv
from events where event_type = '{PV_EVENT}' group by 1
""")
def q_daily_pv_uv_stream(spark: SparkSession, sf_dir: str):
    return sdaily.read_daily(spark, _daily(spark, sf_dir, ["pv", "uv"])).select("day", "pv", "uv")


@register("daily_live_stream", covers="X5 A8 K4", oracle=f"""
select {LOCAL_DAY_SQL} as day, count(distinct user_id) as live_users,
       count(*) * cast(3.0 as double) / count(distinct user_id) / 60 as live_avg
from events where event_type = '{LIVE_EVENT}' group by 1
""")
def q_daily_live_stream(spark: SparkSession, sf_dir: str):
    return sdaily.read_daily(spark, _daily(spark, sf_dir, ["live_beats", "live_users"])).select("day", "live_users", "live_avg")


@register("daily_snapshot_stream", covers="X1 X5 X6 X7 X8 K4 A6 A7 A8", oracle=f"""
with a as (
  select {LOCAL_DAY_SQL} as day, event_type, count(*) as n, count(distinct user_id) as u
  from events where event_type in ('{PV_EVENT}', '{LIVE_EVENT}') group by all)
select day, max(case when event_type = '{PV_EVENT}' then n end) as pv,
       max(case when event_type = '{PV_EVENT}' then u end) as uv,
       max(case when event_type = '{LIVE_EVENT}' then u end) as live_users,
       max(case when event_type = '{LIVE_EVENT}' then n * cast(3.0 as double) / u / 60 end) as live_avg
from a group by day
""")
def q_daily_snapshot_stream(spark: SparkSession, sf_dir: str):
    """All four metrics by four queries (writers) in one keyed table."""
    return sdaily.read_daily(spark, _daily(spark, sf_dir, ["pv", "uv", "live_beats", "live_users"]))


@register("quarantine_stream", covers="X1 D2 D3", oracle=f"""
select event_id, 'no time' as reason from events where event_id % 50 = {NO_TIME}
union all select event_id, 'in the future' from events where event_id % 50 = {FUTURE}
""")
def q_quarantine_stream(spark: SparkSession, sf_dir: str):
    bad = sdaily.quarantined(_timed(spark, sf_dir)).select("event_id", "reason")
    return run_to_parquet(bad, name="quarantine")


@register("hot_items_stream", covers="X4 X11 W2 T1", oracle=HOT_ITEMS_SQL + """
select item_id, window_end, view_count, cast(rank as integer) as rank from r where rank <= 3
""")
def q_hot_items_stream(spark: SparkSession, sf_dir: str):
    ev = read_table(spark, sf_dir, "events")
    end = _end_row(ev, "1 day")     # closes the last window
    out = shared_dir(spark, "hot-items")
    run_foreach_batch(shot.window_counts(clickstream(replay(spark, ev, [end])), behavior=PV_EVENT), shot.top_n_sink(out),
                      "append", name="hot")
    return spark.read.parquet(out).drop("batch")


# Running totals of the day at every tick of 5 s before which an event came, and at its close.
EARLY_SQL = f"""
with e as (
  select {LOCAL_DAY_SQL} as day, (epoch_us(ts) // 5000000 + 1) * 5000 as tick,
         case when row_number() over (partition by {LOCAL_DAY_SQL}, user_id order by ts, event_id) = 1 then 1 else 0 end as new_user,
         (((epoch_us(ts) // 1000 + 28800000) // 86400000) + 1) * 86400000 - 28800000 as day_end
  from events where event_type = '{PV_EVENT}'),
p as (select day, tick, count(*) as n, sum(new_user) as u from e group by all
      union all select distinct day, day_end, 0, 0 from e),
q as (select day, tick, sum(n) as n, sum(u) as u from p group by all)
select day, tick, cast(sum(n) over w as bigint) as pv, cast(sum(u) over w as bigint) as uv
from q window w as (partition by day order by tick)
"""


@register("daily_early_stream", covers="X6 X1 X5 W1 A6 A7", oracle=EARLY_SQL)
def q_daily_early_stream(spark: SparkSession, sf_dir: str):
    """(day, tick, pv, uv): totals at every 5 s of event time, with rows that arrive up to 25 s late within a
    day, and behind its close: those do not count."""
    ev = read_table(spark, sf_dir, "events")
    at = ev.withColumn("_at", F.col("ts") + F.expr("make_dt_interval(0, 0, 0, event_id * 7919 % 25)"))
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    late = ev.where(F.col("ts") < F.lit(first + (last - first) / 5)) if first else ev
    stream = sdaily.guarded(clickstream(replay(spark, at, [late, _end_row(ev, "2 days")], at=("_at", "event_id"))))
    path = shared_dir(spark, "daily-ticks")
    run_foreach_batch(early.tick_increments(stream, PV_EVENT), early.totals_sink(path), "append", name="early")
    return early.read_ticks(spark, path)


# The source partition and the rows whose clock runs ahead: they take the largest valid time before them.
SOURCES, NOW_MS = 4, 7_258_118_400_000


@register("daily_clamped_stream", covers="X1 D2 W1 A6 A7", oracle=f"""
with t as (select event_id, event_type, user_id, user_id % {SOURCES} as src,
                  case when event_id % 50 <> {FUTURE} then ts end as valid from events),
c as (select event_type, user_id, coalesce(valid, max(valid) over (
        partition by src order by event_id rows between unbounded preceding and current row), timestamp '1970-01-01') as ts from t)
select {LOCAL_DAY_SQL} as day, count(*) as pv, count(distinct user_id) as uv
from c where event_type = '{PV_EVENT}' group by 1
""")
def q_daily_clamped_stream(spark: SparkSession, sf_dir: str):
    """One query of chained stateful operators: the clamp by source, a watermark on the
    clamped time, and the daily totals, at each day's close."""
    ev = read_table(spark, sf_dir, "events")
    ahead = ev.withColumn("ts", F.when(F.col("event_id") % 50 == FUTURE, F.lit(FUTURE_TS).cast("timestamp_ntz")).otherwise(F.col("ts")))
    end = _end_row(ev, "2 days").withColumn("event_id", F.lit(2 ** 62))
    rows = clickstream(replay(spark, ahead, [end], at=("event_id",))).withColumn("src", F.pmod("user_id", F.lit(SOURCES)))
    clamped = processors.future_clamp_stream(rows, "src", "time_ms", "event_id", "event_id", 600_000, NOW_MS,
                                             carry=["event", "distinct_id"])
    path = shared_dir(spark, "daily-clamped")
    timed = clamped.withColumn("ts", F.timestamp_millis("guarded_time"))
    run_foreach_batch(early.tick_increments(timed, PV_EVENT), early.totals_sink(path), "append", name="clamped")
    return early.read_ticks(spark, path).groupBy("day").agg(F.max("pv").alias("pv"), F.max("uv").alias("uv"))


@register("daily_expiring_stream", covers="X7 A6 A7", oracle=f"""
select {LOCAL_DAY_SQL} as day, count(*) as pv, count(distinct user_id) as uv
from events where event_type = '{PV_EVENT}' group by 1
""")
def q_daily_expiring_stream(spark: SparkSession, sf_dir: str):
    """Counters with a time to live of two days by the clock, none of which runs out here."""
    counts = expiring.expiring_counts(clickstream(replay(spark, read_table(spark, sf_dir, "events"))), PV_EVENT)
    out = shared_dir(spark, "daily-expiring")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_processing_time(counts, write, "update", name="expiring")
    rows = spark.read.parquet(out).groupBy("day", "bucket").agg(F.max("pv").alias("pv"), F.max("uv").alias("uv"))
    return rows.groupBy("day").agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))


# What the owner of the dimension changes: version 2 has no row for every third customer, others
# new numbers; version 3 has numbers without a value for every seventh.
@register("lookup_stream", covers="J1", oracle="""
with d as (
  select 0 as v, c_custkey as k, c_name as phone from customer
  union all select 1, c_custkey, c_name || '-2' from customer where c_custkey % 3 <> 0
  union all select 2, c_custkey, case when c_custkey % 7 <> 0 then c_name || '-3' end from customer)
select e.event_id, e.user_id, case when d.k is null then '0000' else d.phone end as phone, cast(e.event_id % 3 as integer) as version
from events e left join d on d.k = e.user_id and d.v = e.event_id % 3
""")
def q_lookup_stream(spark: SparkSession, sf_dir: str):
    """Records in three arrivals; before each the dimension changes, and the query goes on from its checkpoint."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("phone"))
    # Every fifth customer has a second row, which comes later and does not count.
    again = cust.where("user_id % 5 = 0").withColumn("phone", F.lit("later"))
    versions = [cust, cust.where("user_id % 3 <> 0").withColumn("phone", F.concat("phone", F.lit("-2"))),
                cust.withColumn("phone", F.when(F.col("user_id") % 7 != 0, F.concat("phone", F.lit("-3"))))]
    base = shared_dir(spark, "lookup")
    checkpoint = None
    for v, dim in enumerate(versions):
        if v == 1:
            again = again.where("user_id % 3 <> 0")
        elif v == 2:
            again = cust.where("user_id % 5 = 0").withColumn("phone", F.lit("later"))
        lookup.publish(dim.withColumn("place", F.lit(0)).unionByName(again.withColumn("place", F.lit(1))), f"{base}/dim")
        ev.where(F.col("event_id") % 3 == v).withColumn("version", F.lit(v)).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("event_id bigint, user_id bigint, version int").option(
            "maxFilesPerTrigger", str(max(1, spark.sparkContext.defaultParallelism))).parquet(f"{base}/in")
        checkpoint = run_foreach_batch(stream, lookup.lookup_sink(f"{base}/dim", f"{base}/out", "user_id", "phone", "place"),
                                       "append", checkpoint=checkpoint, name="lookup")
    return lookup.read_looked_up(spark, f"{base}/out").select("event_id", "user_id", "phone", "version")


@register("word_count_stream", covers="A1 X12 P11", oracle="""
with w as (select unnest(string_split(rtrim(p_name, ' '), ' ')) as word from part)
select word, count(*) as n from w group by word
""")
def q_word_count_stream(spark: SparkSession, sf_dir: str):
    """Counts that change as words arrive, as (false, old) and (true, new) rows, applied to a table."""
    names = replay(spark, read_table(spark, sf_dir, "part").select("p_partkey", "p_name"), at=("p_partkey",))
    path = shared_dir(spark, "word-counts")
    run_foreach_batch(changes.count_changes(words.tokens(names, "p_name", by_lines=False), "word"),
                      changes.table_sink(path, "word"), "update", name="word-count")
    return bucketed.read_table(spark, path).select("word", F.col("cnt").alias("n"))


def _replayed(spark: SparkSession, sf_dir: str):
    return clickstream(replay(spark, read_table(spark, sf_dir, "events")))


@register("rising_alert_stream", covers="X10 U4", oracle=ALERT_SQL + """
select cast(k as varchar) as id, fired_s * 1000 as fired_at, cast(k as varchar) || '温度连续上升' as alert from alerts
""")
def q_rising_alert_stream(spark: SparkSession, sf_dir: str):
    ev = _replayed(spark, sf_dir)
    readings = (ev.select(F.col("distinct_id").alias("id"), "ts", "event_id", "time_us",
                          (F.floor(F.col("time_us") / F.lit(1_000_000)) * 1000).cast("bigint")
                          .alias("time_ms"), F.col("value").alias("temperature"))
                .withWatermark("ts", "0 seconds"))
    alerts = processors.rising_alert_stream(readings, order=("time_us", "event_id"),
                                            timer_ms=ALERT_TIMER_S * 1000)
    return run_to_parquet(alerts, name="alerts")


@register("rolling_peak_stream", covers="W5 A5 K3 X2 P14", oracle="""
with e as (select json_extract_string(props, '$.k') as message_id, user_id as u,
                  epoch_us(ts) // 10000000 as p from events),
c as (select distinct message_id, p - 8639 as q from e),
v as (select c.message_id, c.q, count(distinct e.u) as uv
      from c join e on e.message_id = c.message_id and e.p between c.q and c.q + 8639
      group by all)
select 'room-' || message_id || '+' || message_id as row_key, max(uv) as uv, '0' as max_online
from v group by message_id
""")
def q_rolling_peak_stream(spark: SparkSession, sf_dir: str):
    ev = _replayed(spark, sf_dir).where(F.col("message_id").isNotNull())
    keys = ["message_id", "title"]
    panes = srolling.distinct_panes(ev, keys, "user_id", "time_us", 10)
    store, peaks = shared_dir(spark, "room-panes"), shared_dir(spark, "room-peaks")
    run_foreach_batch(panes, srolling.peak_sink(store, peaks, keys, "user_id", 86400, 10,
                                                composite_key("title", "message_id")),
                      "append", name="room-peak")
    return bucketed.read_table(spark, peaks).select("row_key", "uv", "max_online")


def _cents_stream(spark: SparkSession, sf_dir: str):
    ev = _replayed(spark, sf_dir)
    return ev.select("user_id", "event_id", "time_us",
                     F.round(F.col("value") * 100).cast("bigint").alias("cents"))


@register("running_sum_stream", covers="A2 A3 U4", oracle="""
select user_id as key, cast(sum(cast(round(value * 100) as bigint)) over w as bigint) as running_sum,
       row_number() over w as seq
from events
window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)
""")
def q_running_sum_stream(spark: SparkSession, sf_dir: str):
    out = processors.running_sum_stream(_cents_stream(spark, sf_dir), "user_id", "cents",
                                        ["time_us", "event_id"])
    return run_to_parquet(out, name="running-sum")


@register("pair_average_stream", covers="X9 U3", oracle="""
with s as (select user_id, cast(round(value * 100) as bigint) as c,
                  row_number() over (partition by user_id order by ts, event_id) as n from events),
g as (select user_id, (n - 1) // 2 as group_no, count(*) as k, sum(c) as sc from s group by all)
select user_id as key, cast(sc // 2 as bigint) as avg_value from g where k = 2
""")
def q_pair_average_stream(spark: SparkSession, sf_dir: str):
    out = processors.pair_average_stream(_cents_stream(spark, sf_dir), "user_id", "cents",
                                         ["time_us", "event_id"])
    return run_to_parquet(out, name="pair-average")


@register("changelog_stream", covers="X12", oracle="""
with s as (select event_type as event,
                  row_number() over (partition by event_type order by ts, event_id) as n from events)
select event as key, true as is_add, n as cnt from s
union all select event, false, n - 1 from s where n > 1
""")
def q_changelog_stream(spark: SparkSession, sf_dir: str):
    ev = _replayed(spark, sf_dir).select("event", "time_us", "event_id")
    out = processors.changelog_stream(ev, "event", ["time_us", "event_id"])
    return run_to_parquet(out, name="changelog")


# Rows arrive up to a day late, in another order than their times.
DISORDER_S = 86_400


def _disordered(spark: SparkSession, sf_dir: str):
    """Events in several files by arrival, up to ``DISORDER_S`` after their time, then a row that lets the
    watermark reach the last event."""
    ev = read_table(spark, sf_dir, "events")
    at = ev.withColumn("_at", F.col("ts") + F.expr(f"make_dt_interval(0, 0, 0, event_id * 7919 % {DISORDER_S})"))
    end = _end_row(ev, f"{DISORDER_S} seconds 1 milliseconds")
    return clickstream(replay(spark, at, [end], at=("_at", "event_id"))).withWatermark("ts", f"{DISORDER_S} seconds")


@register("rising_alert_disorder_stream", covers="X10 U4", oracle=ALERT_SQL + """
select cast(k as varchar) as id, fired_s * 1000 as fired_at, cast(k as varchar) || '温度连续上升' as alert from alerts
""")
def q_rising_alert_disorder_stream(spark: SparkSession, sf_dir: str):
    out = ordered.rising_alerts(_disordered(spark, sf_dir), "distinct_id", "time_us", ["event_id"], "value",
                                timer_ms=ALERT_TIMER_S * 1000, unit_ms=1000)
    return run_to_parquet(out, name="alerts-ordered")


@register("running_sum_disorder_stream", covers="A2 A3 U4", oracle="""
select user_id as key, cast(sum(cast(round(value * 100) as bigint)) over w as bigint) as running_sum,
       row_number() over w as seq
from events
window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)
""")
def q_running_sum_disorder_stream(spark: SparkSession, sf_dir: str):
    ev = _disordered(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return run_to_parquet(ordered.running_sums(ev, "user_id", "time_us", ["event_id"], "cents"), name="sums-ordered")
