"""Early results of the daily counts at every 5 s of event time (X6, with W1, X1, X5, A6, A7).

A day's totals are emitted whenever the watermark passes a tick, a multiple of
5 s, before which new events came, and once more when the day closes. A tick's totals
count the events before it, so they do not depend on how the input was cut into triggers.

* Rows are combined in the task that reads them (one row per pane of 5 s and user), so
  an event-heavy user or a replayed burst is small before it is shuffled.
* State is keyed by day and a bucket of the users: a day is as many keys as ``buckets``,
  and users are counted exactly, each in one bucket. A key holds the open panes and the
  users seen before them; a timer at its next tick turns the panes that the watermark
  has passed into increments (new events, new users).
* The sink adds the increments of a trigger up by tick, at most 17,280 rows a day,
  and continues the day's totals from the triggers before.

Events are late by up to 30 s and a day takes rows for 30 s more (X5). There is one
watermark, 60 s behind; a tick's timer is set 30 s before the tick, so it fires when the event
time minus 30 s has passed it. An event whose pane has been emitted counts at the
next tick, after the close in a new row of the close, and after the lateness not at all.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.time import LOCAL_SHIFT_HOURS, local_text_from_ms
from tidemark.operators.daily import PV_EVENT, day_window
from tidemark.session import hadoop_path

# Fixed values of the reference's daily job.
EVERY_MS = 5_000
DISORDER_MS = 30_000
LATENESS_MS = 30_000
DAY_MS = 86_400_000
BUCKETS = 8

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def day_end(tick):
    """End of the local day whose panes end at ``tick`` (both in epoch ms)."""
    shift = LOCAL_SHIFT_HOURS * 3_600_000
    return F.floor((tick + F.lit(shift - 1)) / F.lit(DAY_MS)).cast("bigint") * DAY_MS + F.lit(DAY_MS - shift)


def combined(events: DataFrame, event: str, user: str, every_ms: int) -> DataFrame:
    """(tick, user, n, ts) per batch of rows: ``n`` events of the kind and the largest time.
    Other events keep one row a pane with ``n`` = 0, since they move event time too (D12)."""
    hit = F.col("event") == event
    rows = events.select(
        (F.floor(F.unix_micros("ts") / F.lit(every_ms * 1000)).cast("bigint") * every_ms + every_ms).alias("tick"),
        F.when(hit, F.col(user).cast("string")).alias("user"), F.when(hit, 1).otherwise(0).cast("bigint").alias("n"),
        F.unix_micros("ts").alias("us"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(["tick", "user"]).aggregate([("n", "sum"), ("us", "max")])
            yield from t.select(["tick", "user", "n_sum", "us_max"]).rename_columns(["tick", "user", "n", "us"]).to_batches()

    return rows.mapInArrow(run, "tick bigint, user string, n bigint, us bigint").select(
        "tick", "user", "n", F.timestamp_micros("us").alias("ts"))


class TickCounts(StatefulProcessor):
    """Increments of events and users at each tick, for one day and bucket of users.

    A call to the state costs more than what it moves here, so the open panes are one value and
    the users seen another; ``buckets`` bounds both.
    """

    def __init__(self, every_ms: int, ahead_ms: int):
        self.every, self.ahead = every_ms, ahead_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getValueState("panes", "held binary")      # {tick: (events, users)}
        self.seen = handle.getValueState("seen", "held binary")        # the users of panes that were emitted

    @staticmethod
    def _held(state):
        value = state.get()
        return pickle.loads(value[0]) if value is not None else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[0])
        fired = (timerValues.getCurrentWatermarkInMs() + self.ahead) // self.every * self.every
        found: dict[int, tuple[int, set]] = {}
        for pdf in rows:
            pdf = pdf[pdf["n"] > 0]
            for tick, user, n in zip(pdf["tick"].tolist(), pdf["user"].tolist(), pdf["n"].tolist()):
                tick = min(tick if tick > fired else fired + self.every, end)
                count, users = found.get(tick, (0, set()))
                if user is not None:
                    users.add(user)
                found[tick] = (count + n, users)
        if not found:
            return
        panes = self._held(self.panes)
        if panes is None:
            panes = {}
            self.handle.registerTimer(end - self.ahead)     # the close
            self.handle.registerTimer(end)                  # no row of the day is taken any more
        for tick, (count, users) in found.items():
            before = panes.get(tick, (0, set()))
            panes[tick] = (before[0] + count, before[1] | users)
        self.panes.update((pickle.dumps(panes),))
        self.handle.registerTimer(min(found) - self.ahead)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end, at = int(key[0]), expiredTimerInfo.getExpiryTimeInMs()
        if at >= end:
            self.panes.clear()
            self.seen.clear()
            return
        reached = timerValues.getCurrentWatermarkInMs() + self.ahead
        panes = self._held(self.panes) or {}
        ticks = sorted(t for t in panes if t <= reached)
        out = []
        if ticks:
            seen = self._held(self.seen) or set()
            for tick in ticks:
                count, users = panes.pop(tick)
                out.append((end, tick, count, len(users - seen)))
                seen |= users
            self.seen.update((pickle.dumps(seen),))
            self.panes.update((pickle.dumps(panes),))
            if panes:
                self.handle.registerTimer(min(panes) - self.ahead)
        if at == end - self.ahead:
            out.append((end, end, 0, 0))
        if out:
            yield pd.DataFrame(out, columns=["day_end", "tick", "pv", "uv"], dtype="int64")

    def close(self) -> None:
        pass


def tick_increments(events: DataFrame, event: str = PV_EVENT, user: str = "distinct_id", every_ms: int = EVERY_MS,
                    disorder_ms: int = DISORDER_MS, lateness_ms: int = LATENESS_MS, buckets: int = BUCKETS) -> DataFrame:
    """Append-mode (day_end, tick, pv, uv) increments of every bucket of users; times in epoch ms."""
    rows = combined(events, event, user, every_ms).withWatermark("ts", f"{disorder_ms + lateness_ms} milliseconds")
    # The window, not the time, carries the watermark on: a row is late when its day is.
    keyed = rows.select(day_end(F.col("tick")).alias("day_end"), F.pmod(F.xxhash64("user"), F.lit(buckets)).alias("bucket"),
                        "tick", "user", "n", day_window("ts").alias("w"))
    return keyed.groupBy("day_end", "bucket").transformWithStateInPandas(
        TickCounts(every_ms, lateness_ms), "day_end bigint, tick bigint, pv bigint, uv bigint", "append", "EventTime")


def totals_sink(path: str):
    """foreachBatch function: increments -> running totals by day, appended under
    ``path``/day=<ms>/batch=<id>. A repeated batch replaces its own folders and reads only
    the batches before it, so it writes the same rows again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = batch.groupBy("day_end", "tick").agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv")).persist()
        try:
            if found.isEmpty():
                return
            so_far = Window.partitionBy("day_end").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
            rows = found.select("day_end", "tick", *[F.sum(c).over(so_far).alias(c) for c in ("pv", "uv")])
            # Only the folders of the trigger's own days are listed and read.
            before = _stored(spark, path, [r[0] for r in found.select("day_end").distinct().collect()])
            if before is not None:
                before = (before.where(F.col("batch") < batch_id)
                          .groupBy("day_end").agg(F.max("pv").alias("pv0"), F.max("uv").alias("uv0")))
                rows = rows.join(before, "day_end", "left").select(
                    "day_end", "tick", *[(F.col(c) + F.coalesce(f"{c}0", F.lit(0))).alias(c) for c in ("pv", "uv")])
            (rows.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("day_end", "batch").parquet(path))
        finally:
            found.unpersist()
    return write


def _stored(spark: SparkSession, path: str, days: list[int] | None = None) -> DataFrame | None:
    """What was written, of some days if they are named; None if there is nothing yet."""
    fs, p = hadoop_path(spark, path)
    folders = [path] if days is None else [f"{path}/day_end={d}" for d in days]
    folders = [f for f in folders if fs.exists(hadoop_path(spark, f)[1])]
    if not folders:
        return None
    schema = "tick bigint, pv bigint, uv bigint, day_end bigint, batch bigint"
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """(day, tick ms, pv, uv): the newest totals of every tick that was emitted. Totals
    never fall, so the newest are the largest. No rows before the first tick."""
    stored = _stored(spark, path)
    if stored is None:
        return spark.createDataFrame([], "day string, tick bigint, pv bigint, uv bigint")
    return stored.groupBy("day_end", "tick").agg(F.max("pv").alias("pv"), F.max("uv").alias("uv")).select(
        local_text_from_ms(F.col("day_end") - F.lit(DAY_MS)).alias("day"), "tick", "pv", "uv")
