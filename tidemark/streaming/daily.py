"""Streaming daily PV / UV / live metrics.

* Watermark: the reference allows 30 s of disorder plus 30 s of lateness after
  the window end; Spark has one delay, so the watermark is 60 s (X5).
* Early results (X6): update mode emits only the windows that changed in a
  micro-batch, so each record is counted once and totals live in state.
* State per day window is dropped once the watermark passes the day (X7, X8):
  no TTL or explicit day rollover is needed.
* Events whose time is missing or more than 10 minutes in the future do not
  reach the watermark (X1 guard); they go to a quarantine sink (D3).
* D12: the reference assigns the watermark before filtering event types, so
  every record moves event time. Spark would push a filter below the
  watermark, so with ``watermark_from="all"`` rows are kept and counted with
  ``count_if`` (zero rows are dropped at the sink).

UV is a distinct count, which Spark refuses on streams: it is
``dropDuplicates([day, user, flag])`` followed by a count -- a dedup then an
aggregation, which update mode allows -- in its own query. All queries upsert
their metric into one last-write snapshot, keyed by (day, metric).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import local_text
from tidemark.operators.daily import LIVE_EVENT, PV_EVENT, day_window, live_minutes
from tidemark.operators.guard import MAX_AHEAD_MS
from tidemark.sinks import snapshot
from tidemark.streaming.runner import state_partitions

# Fixed values of the reference's daily job: 30 s out-of-order + 30 s lateness.
WATERMARK_DELAY = "60 seconds"
EARLY_FIRE = "5 seconds"


def _in_time(now_ms: int | None):
    now = F.lit(now_ms) if now_ms is not None else F.unix_millis(F.current_timestamp())
    return F.coalesce((F.col("time_ms") - now) <= F.lit(MAX_AHEAD_MS), F.lit(False))


def guarded(events: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Rows with a time at most 10 min after ``now`` (wall clock at run time unless given)."""
    return events.where(_in_time(now_ms))


def quarantined(events: DataFrame, now_ms: int | None = None) -> DataFrame:
    """D3: the rows that :func:`guarded` leaves out, with the reason."""
    return events.where(~_in_time(now_ms)).withColumn(
        "reason", F.when(F.col("time_ms").isNull(), "no time").otherwise("in the future"))


def pv_counts(events: DataFrame, pv_event: str = PV_EVENT, delay: str = WATERMARK_DELAY,
              watermark_from: str = "all") -> DataFrame:
    """Update-mode (day, pv) counts; with the live event these are the beats."""
    ev = events.withWatermark("ts", delay)
    if watermark_from == "kept":
        ev = ev.where(F.col("event") == pv_event)
    return (ev.groupBy(day_window("ts").alias("w"))
            .agg(F.count_if(F.col("event") == pv_event).alias("pv"))
            .select(local_text("w.start").alias("day"), "pv"))


def uv_counts(events: DataFrame, pv_event: str = PV_EVENT, user: str = "distinct_id",
              delay: str = WATERMARK_DELAY, watermark_from: str = "all") -> DataFrame:
    """Update-mode (day, uv): dedup (day, user) in state, then count."""
    ev = events.withWatermark("ts", delay).withColumn("w", day_window("ts"))
    if watermark_from == "kept":
        ev = ev.where(F.col("event") == pv_event).withColumn("hit", F.lit(True))
    else:
        ev = ev.withColumn("hit", F.col("event") == pv_event)
    return (ev.dropDuplicates(["w", user, "hit"])
            .groupBy("w").agg(F.count_if("hit").alias("uv"))
            .select(local_text("w.start").alias("day"), "uv"))


def metric_rows(counts: DataFrame, metric: str) -> DataFrame:
    """Tall K4 rows (day, metric, value, u_time) from one counts column."""
    return counts.where(F.col(metric) > 0).select(
        "day", F.lit(metric).alias("metric"), F.col(metric).cast("string").alias("value"),
        F.current_timestamp().alias("u_time"))


def upsert_metric_sink(path: str, metric: str, name: str | None = None):
    """foreachBatch function: last-write upsert of one metric's changed days;
    ``name`` is the metric's name in the table, if it differs from the column's."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = metric_rows(batch, metric).withColumn("metric", F.lit(name or metric)).persist()
        try:
            if not rows.isEmpty():      # empty e.g. in the no-data batch after a watermark step
                snapshot.upsert_last_write(rows, path, batch_id)
        finally:
            rows.unpersist()
    return write


def read_daily(spark, path: str) -> DataFrame:
    """(day, pv, uv, live_users, live_avg) from the one table of the daily jobs;
    metrics that no job writes are NULL."""
    tall = snapshot.read_snapshot(spark, path)
    wide = snapshot.pivot_metrics(tall, "day", ["pv", "uv", "live_beats", "live_users"], written_at=None)
    beats, users = F.col("live_beats").cast("bigint"), F.col("live_users").cast("bigint")
    return wide.select("day", F.col("pv").cast("bigint").alias("pv"), F.col("uv").cast("bigint").alias("uv"),
                       users.alias("live_users"), live_minutes(beats, users).alias("live_avg"))


__all__ = ["EARLY_FIRE", "WATERMARK_DELAY", "daily_jobs", "guarded", "metric_rows", "pv_counts", "quarantined",
           "read_daily", "start_daily_jobs", "upsert_metric_sink", "uv_counts"]


def daily_jobs(events: DataFrame, pv_event: str = PV_EVENT, live_event: str = LIVE_EVENT,
               delay: str = WATERMARK_DELAY) -> list[tuple[str, DataFrame, str]]:
    """(metric, update-mode counts, count column) of the four daily metrics."""
    return [("pv", pv_counts(events, pv_event, delay), "pv"),
            ("uv", uv_counts(events, pv_event, delay=delay), "uv"),
            ("live_beats", pv_counts(events, live_event, delay), "pv"),
            ("live_users", uv_counts(events, live_event, delay=delay), "uv")]


def start_daily_jobs(events: DataFrame, base: str, pv_event: str = PV_EVENT,
                     live_event: str | None = None, trigger: dict | None = None,
                     delay: str = WATERMARK_DELAY) -> list:
    """Entry 1 as running queries: pv, uv (and live beats / users) per local
    day, all upserted into the last-write snapshot ``base``/daily (:func:`read_daily`).

    The default trigger fires every 5 s (X6 early results); checkpoints live
    under ``base`` so a restart resumes exactly (X13). Returns the queries.
    """
    trig = trigger or {"processingTime": EARLY_FIRE}
    out = []
    with state_partitions(events.sparkSession):
        for name, df, column in daily_jobs(events, pv_event, live_event or LIVE_EVENT, delay):
            q = (df.writeStream.outputMode("update")
                 .foreachBatch(upsert_metric_sink(f"{base}/daily", column, name))
                 .option("checkpointLocation", f"{base}/_checkpoints/{name}")
                 .queryName(f"daily_{name}").trigger(**trig).start())
            out.append(q)
    return out
