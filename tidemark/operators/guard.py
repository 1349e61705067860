"""The future-time guard.

A record whose time is missing, not a number, or more than 10 minutes ahead
of "now" must not move event time forward. ``now`` is a parameter so that
batch runs and tests are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequence import keyed_running

# Fixed value of the reference's watermark guard: 10 minutes ahead of now.
MAX_AHEAD_MS = 600_000


def is_future(time_ms: Column, now_ms: int, max_ahead_ms: int = MAX_AHEAD_MS) -> Column:
    return (time_ms - F.lit(now_ms)) > F.lit(max_ahead_ms)


def guard_future_clamp(df: DataFrame, time_ms: str, now_ms: int, source: Sequence[str],
                       order: Sequence[str], max_ahead_ms: int = MAX_AHEAD_MS,
                       out: str = "guarded_time") -> DataFrame:
    """D2 ``clamp`` policy (batch): a future record takes the largest valid
    time seen so far on its source partition, in offset order (0 if none),
    and does not raise that maximum. A row without a time keeps none (D3: the
    caller quarantines it). The running max is computed with
    :func:`keyed_running`, so one busy source partition is still split."""
    valid = F.when(~is_future(F.col(time_ms), now_ms, max_ahead_ms), F.col(time_ms).cast("bigint"))
    r = keyed_running(df.withColumn("_valid_t", valid), source, order, maxes=["_valid_t"])
    clamped = F.when(F.col("_valid_t").isNotNull(), F.col(time_ms)).when(
        F.col(time_ms).isNotNull(), F.coalesce(F.col("running_max__valid_t"), F.lit(0).cast("bigint")))
    return r.withColumn(out, clamped).drop("_valid_t", "running_max__valid_t", "seq")
