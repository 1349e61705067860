"""Batch forms of the reference's keyed stateful functions.

The streaming forms are :mod:`tidemark.streaming.processors`. These batch
twins compute the same output over a whole table:

* running sums, count-of-2 averages and retract changelogs come from
  :func:`keyed_running`, which splits a hot key over many tasks;
* the rising-value alert is an ordered fold with timers (X10), run over the
  stretches between falls, which split a hot key too (see :func:`rising_alerts`).

Rules for bad values, the same on streams: a NULL key is a key like any other;
a NULL summand counts as 0; a reading without a time or whose value is NULL or
NaN is no reading.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sequence import keyed_running

# Fixed values of the reference's keyed functions.
PAIR_SIZE = 2                    # count window of the pair average
ALERT_TIMER_S = 10               # rising-temperature timer, seconds
ALERT_TEXT = "温度连续上升"        # appended to the key in the alert line

SEQ = "_tm_seq"


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   value: str) -> DataFrame:
    """A2 + A3: after each record, the key's running sum of ``value`` and
    running ``sum(1)`` (``seq``)."""
    return keyed_running(df, keys, order, sums=[value])


def pair_average(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 value: str, size: int = PAIR_SIZE) -> DataFrame:
    """Every ``size`` consecutive values of a key -> integer average
    (``sum div size``, truncating); a trailing incomplete group is not emitted."""
    seq = keyed_running(df.select(*keys, *order, value), keys, order, seq_col=SEQ)
    grp = ((F.col(SEQ) - 1) / F.lit(size)).cast("bigint")
    return (seq.groupBy(*keys, grp.alias("group_no"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.coalesce(value, F.lit(0))).alias("_s"))
            .where(F.col("_n") == size)
            .select(*keys, "group_no", F.expr(f"_s div {size}").alias("avg_value")))


def retract_changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The retract stream of an updating ``count(*)`` per key.

    Record n of a key emits (false, n-1) when n > 1, then (true, n);
    ``change_seq`` is the position in the key's changelog.
    """
    seq = keyed_running(df.select(*keys, *order), keys, order, seq_col=SEQ)
    n = F.col(SEQ)
    add = F.struct((2 * n - 1).alias("change_seq"), F.lit(True).alias("is_add"), n.alias("cnt"))
    retract = F.struct((2 * n - 2).alias("change_seq"), F.lit(False).alias("is_add"),
                       (n - 1).alias("cnt"))
    rows = F.when(n > 1, F.array(retract, add)).otherwise(F.array(add))
    return seq.select(*keys, F.inline(rows))


def alert_step(last: float, due: int, t: int, v: float, timer: int) -> tuple[int, bool]:
    """One reading of the alert rule: (timer pending after it, or 0; whether a
    timer fired before it).

    A timer due by now fires first. A rise arms a timer unless one is pending;
    a fall, or a previous value of exactly 0.0, cancels it.
    """
    fired = 0 < due <= t
    if v > last and not due > t:
        return t + timer, fired
    if last > v or last == 0.0 or fired:
        return 0, fired
    return due, fired


def is_reading(t: str, value: str):
    """Whether a row is a reading: it has a time and a value that is a number."""
    return F.col(t).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))


def _fold_stretches(key: str, timer: int, end: int):
    """Fold rows sorted by stretch: ``first`` opens one, ``closes`` is the fall that ends it."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        due, owner = 0, None        # the pending timer of the open stretch, and its key
        kind = None
        for b in batches:
            keys = b.column(key)
            kind = keys.type
            t, v, last, first, closes = (b.column(c).to_numpy(zero_copy_only=False) for c in ("t", "v", "last", "first", "closes"))
            out: list[tuple] = []
            for i in range(b.num_rows):
                if first[i]:
                    if 0 < due <= end:          # no reading followed: the end of the input decides
                        out.append((owner, due))
                    due, owner = 0, keys[i].as_py()
                before = due
                due, fired = alert_step(last[i], due, int(t[i]), v[i], timer)
                if fired:
                    out.append((owner, before))
                if closes[i]:
                    due = 0
            yield alerts(out, kind)
        if kind is not None and 0 < due <= end:
            yield alerts([(owner, due)], kind)

    def alerts(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], kind), pa.array([d for _, d in out], pa.int64())],
                                          [key, "fired_at"])

    return fold


def rising_alerts(df: DataFrame, key: str, t: str, tie: str | Sequence[str], value: str,
                  timer_s: int = ALERT_TIMER_S) -> DataFrame:
    """X10 in event time, exact and split across tasks even for one hot key.

    Rules, per key in (t, tie) order, are :func:`alert_step`. At the end of the
    input a pending timer fires if the input's event time, its largest ``t``, reached it. Rows
    that are no readings are left out (:func:`is_reading`). Output: (key, fired_at, alert).

    A fall leaves no timer pending, whatever came before. So a key's readings
    are cut into stretches that begin at a fall; a stretch is folded by itself, and
    the fall that ends it is its last row, at which a due timer still fires. Two
    range scans (:func:`keyed_running`) give the previous value and the number of
    falls so far, then stretches are dealt by (key, number). The work of one
    task is bounded by the longest stretch without a fall, not by the key.
    """
    ties = [tie] if isinstance(tie, str) else list(tie)
    rows = df.where(is_reading(t, value))
    end = rows.agg(F.max(t)).first()[0]
    base = rows.select(key, F.col(t).cast("bigint").alias("t"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)],
                       F.col(value).cast("double").alias("v"))
    order = ["t", *[f"_tie{i}" for i in range(len(ties))]]
    seen = keyed_running(base, [key], order, lags=["v"], seq_col="pos").select(
        key, "pos", "t", "v", F.coalesce("prev_v", F.lit(0.0)).alias("last"),
        ((F.col("pos") > 1) & (F.col("v") < F.col("prev_v"))).cast("bigint").alias("fall"))
    cut = keyed_running(seen, [key], ["pos"], sums=["fall"], seq_col="_pos")
    number = F.col("running_fall")
    own = F.struct(number.alias("stretch"), F.lit(False).alias("closes"))
    ends = F.struct((number - 1).alias("stretch"), F.lit(True).alias("closes"))
    parts = (cut.select(key, "pos", "t", "v", "last", "fall", F.explode(
                 F.when(F.col("fall") == 1, F.array(own, ends)).otherwise(F.array(own))).alias("s"))
             .select(key, "pos", "t", "v", "last", "s.stretch", "s.closes",
                     (~F.col("s.closes") & ((F.col("pos") == 1) | (F.col("fall") == 1))).alias("first"))
             .repartition(key, "stretch").sortWithinPartitions(key, "stretch", "pos"))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("fired_at", T.LongType())])
    fired = parts.mapInArrow(_fold_stretches(key, timer_s, end if end is not None else 0), schema)
    return fired.withColumn("alert", F.concat(F.col(key).cast("string"), F.lit(ALERT_TEXT)))
