"""Keyed stateful streaming functions as ``transformWithStateInPandas``
processors (U4, X9, X10, X12, A2, A3).

State is per key in the RocksDB state store, checkpointed with the query, so
a restarted query resumes exactly. Within a micro-batch the rows of one key
are processed in event order (``order`` columns); across micro-batches in
arrival order, as a keyed process function sees them. A key's rows of one
micro-batch are sorted together in memory, so the source's per-trigger limit
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) bounds that work, also
for a hot key; state itself is O(1) per key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import (BooleanType, LongType, StringType, StructField,
                               StructType)

from tidemark.operators import keyed
from tidemark.operators.keyed import (ALERT_TEXT, ALERT_TIMER_S, PAIR_SIZE, alert_step,
                                      is_reading)

from tidemark.streaming.runner import ROCKSDB  # noqa: E402,F401  (re-exported)

# The processors are unpickled by a Python runner on the driver that does not
# see files added with addPyFile: ship this module's classes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(keyed)


def _ordered(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(list(order), kind="stable") if order else pdf


def _key_text(key) -> str:
    return str(key[0])


class RisingAlertProcessor(StatefulProcessor):
    """Arm an event-time timer on a rise (if none is pending), cancel it
    on a fall or when the previous reading is exactly 0.0, alert when it fires.

    Timers due at or before a new reading of the same key fire before that
    reading is applied (Spark hands new rows over before it fires timers);
    the watermark fires the rest (``handleExpiredTimer``).
    """

    def __init__(self, time_col: str = "time_ms", value: str = "temperature",
                 order: Sequence[str] = ("time_ms",), timer_ms: int = ALERT_TIMER_S * 1000):
        self.time_col, self.value, self.order, self.timer_ms = time_col, value, order, timer_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last double")
        self.due = handle.getValueState("due", "due bigint")

    def _out(self, key, fired: list[int]) -> pd.DataFrame:
        k = _key_text(key)
        return pd.DataFrame({"id": [k] * len(fired), "fired_at": np.asarray(fired, dtype=np.int64),
                             "alert": [k + ALERT_TEXT] * len(fired)})

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, self.order)
        last = self.last.get()[0] if self.last.exists() else 0.0
        due = self.due.get()[0] if self.due.exists() else 0
        fired: list[int] = []
        timer = due
        for t, v in zip(pdf[self.time_col].to_numpy(dtype=np.int64),
                        pdf[self.value].to_numpy(dtype=np.float64)):
            before = due
            due, went = alert_step(last, due, int(t), float(v), self.timer_ms)
            if went:
                fired.append(before)
            last = float(v)
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            if due:
                self.handle.registerTimer(due)
        self.last.update((last,))
        self.due.update((due,))
        if fired:
            yield self._out(key, fired)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if self.due.exists() and self.due.get()[0] == at:
            self.due.update((0,))
            yield self._out(key, [at])

    def close(self) -> None:
        pass


class PairAverageProcessor(StatefulProcessor):
    """(count, sum) in value state; at ``size`` values emit sum div count
    and clear. A trailing incomplete group stays in state, unemitted."""

    def __init__(self, value: str = "value", order: Sequence[str] = (), size: int = PAIR_SIZE):
        self.value, self.order, self.size = value, order, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "n bigint, s bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, self.order)
        n, s = self.acc.get() if self.acc.exists() else (0, 0)
        vals = pdf[self.value].to_numpy(dtype=np.int64)
        whole = (n + len(vals)) // self.size            # groups that are complete now
        if not whole:
            self.acc.update((n + len(vals), int(s + vals.sum())))
            return
        first = self.size - n                           # values that complete the open group
        used = first + (whole - 1) * self.size
        sums = np.append(s + vals[:first].sum(), vals[first:used].reshape(-1, self.size).sum(axis=1))
        avg = np.where(sums >= 0, sums // self.size, -(-sums // self.size))   # toward zero
        rest = vals[used:]
        if len(rest):
            self.acc.update((len(rest), int(rest.sum())))
        else:
            self.acc.clear()
        yield pd.DataFrame({"key": [key[0]] * whole, "avg_value": avg.astype(np.int64)})

    def close(self) -> None:
        pass


class ChangelogProcessor(StatefulProcessor):
    """The retract changelog of a per-key ``count(*)``:
    (false, old) then (true, new) for every record."""

    def __init__(self, order: Sequence[str] = ()):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "c bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, self.order)
        c = self.count.get()[0] if self.count.exists() else 0
        n = len(pdf)
        cnts = np.repeat(np.arange(c, c + n + 1, dtype=np.int64), 2)[1:-1]   # c, c+1, c+1, ... c+n
        adds = np.arange(2 * n) % 2 == 1
        skip = 1 if c == 0 else 0                       # nothing to retract before the first record
        self.count.update((c + n,))
        yield pd.DataFrame({"key": [key[0]] * (2 * n - skip), "is_add": adds[skip:], "cnt": cnts[skip:]})

    def close(self) -> None:
        pass


class RunningSumProcessor(StatefulProcessor):
    """A2 + A3: after every record, the key's running sum and running count."""

    def __init__(self, value: str = "value", order: Sequence[str] = ()):
        self.value, self.order = value, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "n bigint, s bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, self.order)
        n, s = self.acc.get() if self.acc.exists() else (0, 0)
        vals = pdf[self.value].to_numpy(dtype=np.int64)
        sums = s + np.cumsum(vals)
        counts = n + np.arange(1, len(vals) + 1, dtype=np.int64)
        if len(vals):
            self.acc.update((int(counts[-1]), int(sums[-1])))
        yield pd.DataFrame({"key": [key[0]] * len(vals), "running_sum": sums, "seq": counts})

    def close(self) -> None:
        pass


class FutureClampProcessor(StatefulProcessor):
    """D2 ``clamp`` on a stream, keyed by source partition: a record more than
    ``max_ahead_ms`` after ``now`` takes the largest valid time seen so far on
    its partition (0 if none) and does not raise it; valid records pass and
    raise it. Rows are handled in offset order."""

    def __init__(self, time_col: str, offset_col: str, id_col: str, max_ahead_ms: int,
                 now_ms: int | None = None, carry: Sequence[str] = ()):
        self.time_col, self.offset_col, self.id_col, self.carry = time_col, offset_col, id_col, list(carry)
        self.max_ahead_ms, self.now_ms = max_ahead_ms, now_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "t bigint")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, [self.offset_col])
        now = self.now_ms if self.now_ms is not None else timerValues.getCurrentProcessingTimeInMs()
        top = self.top.get()[0] if self.top.exists() else None
        t = pdf[self.time_col].to_numpy(dtype=np.int64)
        ahead = t - now > self.max_ahead_ms
        none = np.iinfo(np.int64).min
        tops = np.maximum.accumulate(np.append(none if top is None else top, np.where(ahead, none, t)))[1:]
        out = np.where(ahead, np.where(tops == none, 0, tops), t)
        if tops[-1] != none:
            self.top.update((int(tops[-1]),))
        yield pd.DataFrame({"id": pdf[self.id_col].to_numpy(dtype=np.int64), "guarded_time": out,
                            **{c: pdf[c].to_numpy() for c in self.carry}})

    def close(self) -> None:
        pass


def future_clamp_stream(df: DataFrame, source: str, time_col: str, offset_col: str,
                        id_col: str, max_ahead_ms: int, now_ms: int | None = None,
                        carry: Sequence[str] = ()) -> DataFrame:
    """D2 clamp for streams; output (id, guarded_time, carried columns). Rows without a time are
    not given one: they belong in quarantine (D3) and are left out here. A watermark may
    follow on the guarded time, and stateful operators behind it."""
    needed = dict.fromkeys([source, time_col, offset_col, id_col, *carry])
    df = df.where(F.col(time_col).isNotNull()).select(*needed)
    schema = StructType([StructField("id", LongType()), StructField("guarded_time", LongType()),
                         *[df.schema[c] for c in carry]])
    proc = FutureClampProcessor(time_col, offset_col, id_col, max_ahead_ms, now_ms, carry)
    return df.groupBy(source).transformWithStateInPandas(proc, schema, "append", "None")


def _key_field(df: DataFrame, key: str) -> StructField:
    return StructField("key", df.schema[key].dataType)


def _zero_for_null(df: DataFrame, value: str) -> DataFrame:
    """NULL counts as 0; said before the rows become pandas, where a NULL would turn longs to doubles."""
    return df.withColumn(value, F.coalesce(F.col(value), F.lit(0)).cast("bigint"))


def rising_alert_stream(readings: DataFrame, key: str = "id", time_col: str = "time_ms",
                        value: str = "temperature", order: Sequence[str] = ("time_ms",),
                        timer_ms: int = ALERT_TIMER_S * 1000, time_mode: str = "EventTime") -> DataFrame:
    """X10 on a stream: with ``EventTime`` timers follow the watermark of
    ``readings``, with ``ProcessingTime`` the clock. Rows that are no readings are left out."""
    schema = StructType([StructField("id", StringType()), StructField("fired_at", LongType()),
                         StructField("alert", StringType())])
    return readings.where(is_reading(time_col, value)).groupBy(key).transformWithStateInPandas(
        RisingAlertProcessor(time_col, value, order, timer_ms), schema, "append", time_mode)


def pair_average_stream(df: DataFrame, key: str, value: str, order: Sequence[str] = ()) -> DataFrame:
    schema = StructType([_key_field(df, key), StructField("avg_value", LongType())])
    return _zero_for_null(df, value).groupBy(key).transformWithStateInPandas(
        PairAverageProcessor(value, order), schema, "append", "None")


def changelog_stream(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    schema = StructType([_key_field(df, key), StructField("is_add", BooleanType()),
                         StructField("cnt", LongType())])
    return df.groupBy(key).transformWithStateInPandas(
        ChangelogProcessor(order), schema, "append", "None")


def running_sum_stream(df: DataFrame, key: str, value: str, order: Sequence[str] = ()) -> DataFrame:
    schema = StructType([_key_field(df, key), StructField("running_sum", LongType()),
                         StructField("seq", LongType())])
    return _zero_for_null(df, value).groupBy(key).transformWithStateInPandas(
        RunningSumProcessor(value, order), schema, "append", "None")


__all__ = ["ROCKSDB", "ChangelogProcessor", "FutureClampProcessor", "PairAverageProcessor",
           "RisingAlertProcessor", "RunningSumProcessor", "changelog_stream", "future_clamp_stream",
           "pair_average_stream", "rising_alert_stream", "running_sum_stream"]
