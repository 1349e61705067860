"""Keyed functions in event order, whatever order the triggers bring the rows in.

A row waits in state until the watermark has passed its time; then no earlier row can come
any more. A call to the state costs far more than what it moves, so it is made for a bucket of keys
(``BUCKETS``, by hash) and not for a key: the calls of a trigger do not grow with the keys. A bucket
holds its keys' values and its waiting rows. As many rows as ``inline`` wait in one value; more
wait in slots of event time, a map state: one entry holds the rows of a stretch of
``slot_ms``, so a key with many rows is read and folded slot by slot and never whole. One event-time
timer per bucket wakes it at its earliest waiting row, or where a function has
something due; everything the watermark has passed is then folded, key by key, in the order
of time and ties.

A fold is a small object: the schema of its state, what it starts with, ``rows`` (fold some
rows of a key in order) and ``passed`` (the event time reached a point without more rows). The
functions are the rules of :mod:`tidemark.operators.keyed`.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import NumericType

from tidemark.operators import keyed
from tidemark.operators.keyed import ALERT_TEXT, ALERT_TIMER_S, PAIR_SIZE, alert_step, is_reading

SLOT_MS = 3_600_000
INLINE = 65_536           # waiting rows of a bucket that stand in one value
BUCKETS = 512             # groups of keys that share their calls to the state
NO_KEY = -1               # the bucket of the null key

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(keyed)


class AlertFold:
    """The rising-value alert; a timer that is due fires when event time passes it.
    Readings count as of the last whole ``unit_ms``."""

    state, start = "last double, due bigint", (0.0, 0)
    columns = "fired_at bigint, alert string"

    def __init__(self, timer_ms: int, unit_ms: int = 1):
        self.timer_ms, self.unit_ms = timer_ms, unit_ms

    def _out(self, key, fired: list[int]) -> dict | None:
        return {"fired_at": fired, "alert": [None if key is None else str(key) + ALERT_TEXT] * len(fired)} if fired else None

    def rows(self, key, acc: tuple, us: np.ndarray, values: np.ndarray) -> tuple[tuple, dict | None]:
        last, due = acc
        fired = []
        for t, v in zip((us // (1000 * self.unit_ms) * self.unit_ms).tolist(), values.tolist()):
            before = due
            due, went = alert_step(last, due, t, v, self.timer_ms)
            if went:
                fired.append(before)
            last = v
        return (last, due), self._out(key, fired)

    def passed(self, key, acc: tuple, ms: int) -> tuple[tuple, dict | None]:
        last, due = acc
        return ((last, 0), self._out(key, [due])) if 0 < due <= ms else (acc, None)

    def due(self, acc: tuple) -> int:
        return acc[1]


class _Untimed:
    """A fold that waits for nothing but rows."""

    def passed(self, key, acc, ms):
        return acc, None

    def due(self, acc) -> int:
        return 0


class SumFold(_Untimed):
    """A2 + A3: after every record, the key's running sum and running count."""

    state, start = "n bigint, s bigint", (0, 0)
    columns = "running_sum bigint, seq bigint"

    def rows(self, key, acc, us, values):
        n, s = acc
        sums = s + np.cumsum(values)
        return (n + len(values), int(sums[-1])), {"running_sum": sums, "seq": np.arange(n + 1, n + len(values) + 1)}


class PairFold(_Untimed):
    """The average of every ``size`` consecutive values, truncated toward zero."""

    state, start = "n bigint, s bigint", (0, 0)
    columns = "avg_value bigint"

    def __init__(self, size: int = PAIR_SIZE):
        self.size = size

    def rows(self, key, acc, us, values):
        n, s = acc
        number = (n + np.arange(len(values))) // self.size      # the group of each value
        sums = np.bincount(number, minlength=1).astype(np.int64) * 0
        np.add.at(sums, number, values)
        sums[0] += s
        whole = (n + len(values)) // self.size
        open_sum = int(sums[whole]) if whole < len(sums) else 0
        if not whole:
            return (n + len(values), open_sum), None
        done = sums[:whole]
        return ((n + len(values)) % self.size, open_sum), {
            "avg_value": np.where(done >= 0, done // self.size, -(-done // self.size))}


class ChangelogFold(_Untimed):
    """(false, old) and (true, new) of a running count, for every record."""

    state, start = "n bigint", (0,)
    columns = "is_add boolean, cnt bigint"

    def rows(self, key, acc, us, values):
        c, n = acc[0], len(values)
        counts = np.repeat(np.arange(c, c + n + 1), 2)[1:-1]
        adds = np.arange(2 * n) % 2 == 1
        skip = 1 if c == 0 else 0                # nothing to retract before the first record
        return (c + n,), {"is_add": adds[skip:], "cnt": counts[skip:]}


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes | None) -> pa.Table | None:
    return pa.ipc.open_stream(data).read_all() if data is not None else None


def _joined(tables: list[pa.Table]) -> pa.Table | None:
    return pa.concat_tables(tables, promote_options="permissive").combine_chunks() if tables else None


class _Values:
    """The values of a bucket's keys: ``keys`` and, in the same order, what the fold holds of each."""

    def __init__(self, fold, table: pa.Table | None):
        self.fold = fold
        self.types = [(n, pa.float64() if t == "double" else pa.int64()) for n, t in (f.split() for f in fold.state.split(","))]
        self.keys = table["key"].combine_chunks() if table is not None else None
        self.held = list(zip(*(table[n].to_pylist() for n, _ in self.types))) if table is not None else []

    def number(self, keys: pa.ChunkedArray) -> pa.ChunkedArray:
        """Each key's place; new keys get the fold's start."""
        if self.keys is None:
            self.keys = pc.unique(keys)
        else:
            met = pc.unique(keys)
            new = met.filter(pc.is_null(pc.index_in(met, value_set=self.keys)))
            self.keys = pa.concat_arrays([self.keys, new]) if len(new) else self.keys
        self.held += [self.fold.start] * (len(self.keys) - len(self.held))
        return pc.index_in(keys, value_set=self.keys)

    def table(self) -> pa.Table | None:
        if self.keys is None:
            return None
        columns = zip(*self.held)
        return pa.table([self.keys, *(pa.array(c, t) for c, (_, t) in zip(columns, self.types))], ["key", *(n for n, _ in self.types)])


class EventOrdered(StatefulProcessor):
    """Runs ``fold`` over the rows (key, us, tie0.., value) of a bucket of keys, each key's in event order."""

    def __init__(self, fold, ties: int, slot_ms: int, inline: int):
        self.fold, self.slot_us, self.inline = fold, slot_ms * 1000, inline
        self.order = [("us", "ascending"), *[(f"tie{i}", "ascending") for i in range(ties)]]
        self.names = [n for n, _ in self.order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getValueState("values", "held binary")
        self.head = handle.getValueState("head", "slots array<bigint>, rows binary, wake bigint")
        self.slots = handle.getMapState("slots", "slot bigint", "rows binary")

    def _start(self) -> tuple:
        head = self.head.get()
        return (list(head[0]), _unpacked(head[1]), head[2]) if head is not None else ([], None, 0)

    def _stop(self, slots: list[int], rows: pa.Table | None, wake: int) -> None:
        self.head.update((slots, None if rows is None or not rows.num_rows else _packed(rows), wake))

    def _slot(self, slot: int) -> pa.Table:
        return _unpacked(self.slots.getValue((slot,))[0])

    def _arrived(self, pdf: pd.DataFrame) -> pa.Table:
        # A float key may be NaN, which is not null; ties that are null came as floats.
        whole = [pa.array(pdf[n]).cast(pa.int64()) for n in self.names]
        return pa.table([pa.array(pdf["key"], from_pandas=False), *whole, pa.array(pdf["value"])], ["key", *self.names, "value"])

    def _spread(self, slots: list[int], rows: pa.Table) -> None:
        """Put ``rows`` into their slots."""
        number = rows["us"].to_numpy() // self.slot_us
        by_slot = np.argsort(number, kind="stable")
        rows, number = rows.take(pa.array(by_slot)), number[by_slot]
        first = np.flatnonzero(np.diff(number, prepend=number[0] - 1))
        known = set(slots)
        for at, end in zip(first.tolist(), [*first[1:].tolist(), len(number)]):
            part, s = rows.slice(at, end - at), int(number[at])
            if s in known:
                part = _joined([self._slot(s), part])
            else:
                slots.append(s)
            self.slots.updateValue((s,), (_packed(part),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slots, held, wake = self._start()
        first, parts, size = None, [] if held is None else [held], 0 if held is None else held.num_rows
        for pdf in rows:                         # frames are joined up to ``inline`` rows, never all
            if not len(pdf):
                continue
            table = self._arrived(pdf)
            low = pc.min(table["us"]).as_py()
            first = low if first is None else min(first, low)
            parts.append(table)
            size += table.num_rows
            if size > self.inline:
                self._spread(slots, _joined(parts))
                parts, size = [], 0
        if first is not None:
            self._stop(slots, _joined(parts), self._woken(wake, -(-first // 1000)))
        yield from ()

    def _woken(self, old: int, at: int) -> int:
        """The bucket's one timer, at ``at`` unless it is earlier (0: there is none)."""
        if old and old <= at:
            return old
        if old:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        return at

    def _ready(self, slots: list[int], held: pa.Table | None, limit: int) -> Iterator[pa.Table]:
        """The waiting rows up to ``limit`` in tables, each later than the one before; they leave the
        slots. ``held`` are those in no slot, sorted by time."""
        us = held["us"].to_numpy() if held is not None else np.empty(0, np.int64)
        at, parts, size = 0, [], 0
        for slot in sorted(s for s in slots if s * self.slot_us <= limit):
            table = self._slot(slot)
            now = pa.array(table["us"].to_numpy() <= limit)
            rest = table.filter(pc.invert(now))
            parts.append(table.filter(now))
            size += parts[-1].num_rows
            if rest.num_rows:
                self.slots.updateValue((slot,), (_packed(rest),))
            else:
                self.slots.removeKey((slot,))
                slots.remove(slot)
            if size >= self.inline:
                upto = int(np.searchsorted(us, min((slot + 1) * self.slot_us, limit + 1)))
                yield _joined([*parts, *([held.slice(at, upto - at)] if upto > at else [])])
                at, parts, size = upto, [], 0
        upto = int(np.searchsorted(us, limit + 1))
        if upto > at:
            parts.append(held.slice(at, upto - at))
        if parts:
            yield _joined(parts)

    def _folded(self, bucket: int, values: _Values, rows: pa.Table) -> pd.DataFrame | None:
        rows = rows.append_column("number", values.number(rows["key"])).sort_by([("number", "ascending"), *self.order])
        number, us, value = (rows[c].to_numpy() for c in ("number", "us", "value"))
        first = np.flatnonzero(np.diff(number, prepend=-1))
        owners, outs = [], []
        for at, end in zip(first.tolist(), [*first[1:].tolist(), len(number)]):
            n = int(number[at])
            values.held[n], out = self.fold.rows(self._name(bucket, values, n), values.held[n], us[at:end], value[at:end])
            if out:
                owners.append(n)
                outs.append(out)
        return self._frame(bucket, values, owners, outs) if outs else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        limit, bucket = now * 1000, key[0]
        slots, held, wake = self._start()
        if wake > now:
            return
        state = self.values.get()
        values = _Values(self.fold, _unpacked(state[0]) if state is not None else None)
        held = held.sort_by([("us", "ascending")]) if held is not None else None
        for rows in self._ready(slots, held, limit):
            if rows.num_rows:
                out = self._folded(bucket, values, rows)
                if out is not None:
                    yield out
        owners, outs = [], []
        for n, acc in enumerate(values.held):
            if 0 < self.fold.due(acc) <= now:
                values.held[n], out = self.fold.passed(self._name(bucket, values, n), acc, now)
                if out:
                    owners.append(n)
                    outs.append(out)
        if outs:
            yield self._frame(bucket, values, owners, outs)
        next_at = [d for d in map(self.fold.due, values.held) if d]
        if held is not None:
            held = held.slice(int(np.searchsorted(held["us"].to_numpy(), limit + 1)))
            next_at += [-(-held["us"][0].as_py() // 1000)] if held.num_rows else []
        # Of a slot that the watermark stands in, the rest is later than the watermark.
        next_at += [max(-(-s * self.slot_us // 1000), now + 1) for s in slots]
        if values.keys is not None:
            self.values.update((_packed(values.table()),))
        self._stop(slots, held, self._woken(0, min(next_at)) if next_at else 0)

    def _name(self, bucket: int, values: _Values, n: int):
        return None if bucket == NO_KEY else values.keys[n].as_py()

    def _frame(self, bucket: int, values: _Values, owners: list[int], outs: list[dict]) -> pd.DataFrame:
        """The folds' outputs of the keys ``owners`` in one frame."""
        sizes = [len(next(iter(out.values()))) for out in outs]
        whose = values.keys.take(pa.array(np.repeat(owners, sizes))).to_pandas() if bucket != NO_KEY else [None] * sum(sizes)
        columns = {c: [out[c] for out in outs] for c in outs[0]}
        return pd.DataFrame({"key": whose, **{
            c: np.concatenate(v) if isinstance(v[0], np.ndarray) else list(chain.from_iterable(v)) for c, v in columns.items()}})

    def close(self) -> None:
        pass


def in_event_order(df: DataFrame, fold, key: str, time_us: str, ties: Sequence[str], value, ts: str = "ts",
                   slot_ms: int = SLOT_MS, inline: int = INLINE, buckets: int = BUCKETS) -> DataFrame:
    """``fold`` over the rows of each key of a stream with a watermark on ``ts``; output (key, fold's
    columns). Ties must be longs and make rows unique within a time. Rows without a time are left out."""
    kind = df.schema[key].dataType
    # A null would turn the whole numbers beside it into floats; its bucket tells it.
    name = F.coalesce(F.col(key), F.lit(0).cast(kind)) if isinstance(kind, NumericType) else F.col(key)
    bucket = F.when(F.col(key).isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    rows = df.where(F.col(time_us).isNotNull()).select(
        bucket.alias("bucket"), name.alias("key"), F.col(time_us).cast("bigint").alias("us"),
        *[F.col(t).cast("bigint").alias(f"tie{i}") for i, t in enumerate(ties)], value.alias("value"), ts)
    return rows.groupBy("bucket").transformWithStateInPandas(
        EventOrdered(fold, len(ties), slot_ms, inline), f"key {kind.simpleString()}, {fold.columns}", "append", "EventTime")


def rising_alerts(readings: DataFrame, key: str, time_us: str, ties: Sequence[str], value: str, ts: str = "ts",
                  timer_ms: int = ALERT_TIMER_S * 1000, unit_ms: int = 1, slot_ms: int = SLOT_MS,
                  inline: int = INLINE) -> DataFrame:
    """X10 with disorder: (id, fired_at, alert). A timer fires when the watermark has passed it."""
    out = in_event_order(readings.where(is_reading(time_us, value)), AlertFold(timer_ms, unit_ms), key, time_us, ties,
                         F.col(value).cast("double"), ts, slot_ms, inline)
    return out.select(F.col("key").cast("string").alias("id"), "fired_at", "alert")


def _long(value: str):
    """NULL counts as 0."""
    return F.coalesce(F.col(value), F.lit(0)).cast("bigint")


def running_sums(df: DataFrame, key: str, time_us: str, ties: Sequence[str], value: str, ts: str = "ts") -> DataFrame:
    """A2 + A3 with disorder: (key, running_sum, seq)."""
    return in_event_order(df, SumFold(), key, time_us, ties, _long(value), ts)


def pair_averages(df: DataFrame, key: str, time_us: str, ties: Sequence[str], value: str, ts: str = "ts") -> DataFrame:
    """X9 with disorder: (key, avg_value)."""
    return in_event_order(df, PairFold(), key, time_us, ties, _long(value), ts)


def changelog(df: DataFrame, key: str, time_us: str, ties: Sequence[str], ts: str = "ts") -> DataFrame:
    """X12 with disorder: (key, is_add, cnt)."""
    return in_event_order(df, ChangelogFold(), key, time_us, ties, F.lit(1).cast("bigint"), ts)
