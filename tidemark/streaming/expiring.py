"""Daily counters whose state expires by itself.

The reference keeps the day's page views and users in state with a time to live of two
days: a value lives for that long after it was last written, and one that has
expired is never returned, whether or not it has been removed yet. Spark has such
state in processing time only, so these counters follow the clock and need no
watermark: use :mod:`tidemark.streaming.early` or :mod:`tidemark.streaming.daily` for event time.

Rows are combined by (day, user) in the task that reads them. A day is as many keys as
buckets of users; users are counted exactly, each in one bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.time import local_text
from tidemark.operators.daily import PV_EVENT

# Fixed value of the reference's counters: two days.
TTL_MS = 2 * 86_400_000
BUCKETS = 8

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ExpiringCounts(StatefulProcessor):
    """Totals of one day and bucket: (pv, uv) after every trigger that changed them.

    ``seen`` holds the users that have not expired, each renewed when it comes again;
    ``totals`` is renewed at every trigger. When ``totals`` has expired both begin anew, since a
    count cannot outlive the users it counts.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "pv bigint, uv bigint", self.ttl_ms)
        self.seen = handle.getMapState("seen", "user string", "one boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pv, uv = self.totals.get() if self.totals.exists() else (0, 0)
        if not pv:
            self.seen.clear()
        for pdf in rows:
            for user, n in zip(pdf["user"].tolist(), pdf["n"].tolist()):
                pv += n
                if user is not None:
                    uv += not self.seen.containsKey((user,))
                    self.seen.updateValue((user,), (True,))
        self.totals.update((pv, uv))
        yield pd.DataFrame({"day": [key[0]], "bucket": [key[1]], "pv": [pv], "uv": [uv]})

    def close(self) -> None:
        pass


def expiring_counts(events: DataFrame, event: str = PV_EVENT, user: str = "distinct_id", ttl_ms: int = TTL_MS,
                    buckets: int = BUCKETS) -> DataFrame:
    """Update-mode (day, bucket, pv, uv): the totals of every local day and bucket of
    users that a trigger changed. The trigger must be a processing-time one."""
    rows = events.where(F.col("event") == event).select(local_text("ts").alias("day"), F.col(user).cast("string").alias("user"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).append_column("n", pa.array([1] * b.num_rows, pa.int64()))
            t = t.group_by(["day", "user"]).aggregate([("n", "sum")])
            yield from t.select(["day", "user", "n_sum"]).rename_columns(["day", "user", "n"]).to_batches()

    keyed = rows.mapInArrow(run, "day string, user string, n bigint").withColumn(
        "bucket", F.pmod(F.xxhash64("user"), F.lit(buckets)).cast("bigint"))
    return keyed.groupBy("day", "bucket").transformWithStateInPandas(
        ExpiringCounts(ttl_ms), "day string, bucket bigint, pv bigint, uv bigint", "update", "ProcessingTime")
