"""Streaming rolling distinct counts with a keep-max sink.

1. ``dropDuplicatesWithinWatermark(keys, user, pane)`` passes each distinct
   (key, user, pane) once; records later than the watermark are dropped, as a
   HOP window with a watermark would drop them.
2. ``foreachBatch`` appends the batch's new panes to a pane store (parquet
   under ``<store>/day=<d>/batch=<id>/``, written with dynamic partition
   overwrite, so a replayed batch replaces its own folders), then re-runs the
   sweep over the panes that windows touching the new panes can see: windows
   starting in [pmin-k+1, pmax] cover panes [pmin-k+1, pmax+k-1]. Only the
   day folders of that range are listed and read.
3. Peaks per key are upserted with keep-max (K3). A window's count only grows
   as panes arrive, and every window is recomputed in full in the batch that
   brings its last pane, so keep-max over batches equals the batch answer.
   Windows at the edge of the re-read range are under-counted, which
   keep-max ignores.

State per micro-batch is bounded by the window size (one day of panes per
key), not by the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import rolling
from tidemark.session import hadoop_path
from tidemark.sinks import bucketed, snapshot

DELAY_S = 30                  # the room job's out-of-order bound
DEFAULT_DELAY = f"{DELAY_S} seconds"


def distinct_panes(events: DataFrame, keys: Sequence[str], user: str, time_us: str,
                   slide_s: int, delay: str = DEFAULT_DELAY, ts: str = "ts") -> DataFrame:
    pane = rolling.floor_div(F.col(time_us), slide_s * 1_000_000)
    return (events.withWatermark(ts, delay)
            .select(*keys, user, pane.alias("p"), ts)
            .dropDuplicatesWithinWatermark([*keys, user, "p"]))


def _stored_days(spark, store: str) -> list[int]:
    """Days that have a folder: one listing."""
    fs, p = hadoop_path(spark, store)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return [int(n.split("=", 1)[1]) for n in names if n.startswith("day=")]


def peak_sink(store: str, peaks: str, keys: Sequence[str], user: str, size_s: int,
              slide_s: int, row_key: Column, value: str = "uv", delay_s: int = DELAY_S):
    """foreachBatch function: pane store append + ranged sweep + keep-max upsert,
    then days that the watermark (``delay_s`` behind the largest pane) has left go."""
    k = size_s // slide_s
    per_day = 86400 // slide_s if 86400 % slide_s == 0 else k
    late_panes = -(-delay_s // slide_s)

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.select(*keys, user, "p").distinct().persist()
        try:
            if not new.isEmpty():
                merge(new, batch_id)
        finally:
            new.unpersist()

    def merge(new: DataFrame, batch_id: int) -> None:
        spark = new.sparkSession
        (new.withColumn("day", F.floor(F.col("p") / F.lit(per_day)).cast("bigint"))
         .withColumn("batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch").parquet(store))
        first, last = new.agg(F.min("p"), F.max("p")).first()
        lo, hi = first - (k - 1), last + (k - 1)
        stored = _stored_days(spark, store)
        days = [f"{store}/day={d}" for d in stored if lo // per_day <= d <= hi // per_day]
        # Only the rooms of this batch can have a new peak.
        panes = (spark.read.option("basePath", store).parquet(*days)
                 .where(F.col("p").between(lo, hi)).join(new.select(*keys).distinct(), list(keys), "left_semi")
                 .select(*keys, user, (F.col("p") * slide_s * 1_000_000).alias("_us")))
        seg = rolling.rolling_distinct_segments(panes, keys, user, "_us", size_s, slide_s, bounded=True)
        best = snapshot.keep_max_rows(rolling.peak_distinct(seg, keys), row_key, value)
        bucketed.upsert_keep_max(best, peaks, batch_id, value=value)
        # No window of a pane that may still come reaches back further than this.
        oldest = (last - late_panes - (k - 1)) // per_day
        for d in stored:
            if d < oldest:
                fs, p = hadoop_path(spark, f"{store}/day={d}")
                fs.delete(p, True)
    return write
