"""Per-key positions and running sums that stay parallel when one key is hot.

``row_number()`` / ``sum() over (partition by key order by t)`` sends every
row of a key to one task. If one key holds a third of the data, that task
holds a third of the data. :func:`keyed_running` gives the same result with
work split by *range*, not by key:

1. ``repartitionByRange(keys + order)`` -- Spark samples split points over the
   whole sort key, so a hot key is cut into many contiguous chunks;
2. each partition scans its sorted rows once (Arrow batches) and produces
   positions, sums, maxima and previous values local to the partition;
3. the scanned rows are written once as parquet under the shared
   ``spark.checkpoint.dir`` (compressed and columnar, cheaper than an RDD
   checkpoint at scale) and read back, which also cuts the lineage. Range
   bounds come from sampling, and Spark samples again for every exchange it
   plans, so the totals below and the final rows must read one materialized
   copy, not two recomputations. The partition id is a stored column, so how
   the copy is split on reading does not matter. The copy is removed when the
   application ends;
4. a key can continue across partitions only as the last key of one partition
   and the first key of the next. The scan marks the rows of both, so that only
   those keys, at most two a partition, are totalled. Their prefix sums
   (offsets) are broadcast -- the bound is the partition count, not the data --
   and added to the local values.

One range shuffle of the data, one parquet write, a small aggregate; no task
sees more than its range, and a lost executor is recovered from the written
copy, not by re-sampling.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import remove_at_end, shared_dir

PID = "_tm_pid"
LSEQ = "_tm_lseq"
EDGE = "_tm_edge"      # 1: first key of its partition, 2: last key, 3: both


def _lsum(c: str) -> str:
    return f"_tm_lsum_{c}"


def _lmax(c: str) -> str:
    return f"_tm_lmax_{c}"


def _llag(c: str) -> str:
    return f"_tm_llag_{c}"


def _starts(batch: pa.RecordBatch, keys: list[str], before: list | None) -> np.ndarray:
    """Where a new key starts; NULL equals NULL. ``before``: the key of the row before the batch."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = before is None or before != [batch.column(k)[0].as_py() for k in keys]
    for k in keys:
        col = batch.column(k)
        left, right = col.slice(0, len(col) - 1), col.slice(1)
        differ = pc.fill_null(pc.not_equal(left, right), False).to_numpy(zero_copy_only=False)
        null = col.is_null().to_numpy(zero_copy_only=False)
        new[1:] |= differ | (null[1:] != null[:-1])
    return new


def _values(column: pa.Array, empty) -> np.ndarray:
    """Numbers with ``empty`` for NULL: int64 for integers, double for floats, exact objects for decimals."""
    if pa.types.is_decimal(column.type):
        return np.array([Decimal(empty) if v is None else v for v in column.to_pylist()], object)
    return pc.fill_null(column, pa.scalar(empty, column.type)).to_numpy(zero_copy_only=False)


def _running(values: np.ndarray, new: np.ndarray, carry, op) -> np.ndarray:
    """Running ``op`` within each key; ``carry`` continues the first one."""
    out = np.empty_like(values)
    cuts = np.append(np.flatnonzero(new), len(values))
    if cuts[0] > 0:
        cuts = np.append(0, cuts)
    for low, high in zip(cuts[:-1], cuts[1:]):
        op.accumulate(values[low:high], out=out[low:high])
        if low == 0 and not new[0] and carry is not None:
            out[:high] = op(out[:high], carry)
    return out


LEAST_LONG = -(2 ** 63)


def _local_scan(keys: list[str], sums: list[str], maxes: list[str], lags: list[str]):
    """Positions, sums, maxima and previous values local to the sorted partition."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, n, last_sum, last_max, last_value = None, 0, {}, {}, {}
        held: list[tuple[pa.RecordBatch, np.ndarray]] = []      # the last batch, until the next one is seen
        first_open = True

        def edged(batch: pa.RecordBatch, edge: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(edge)], [*batch.schema.names, EDGE])

        for b in batches:
            if not b.num_rows:
                continue
            new = _starts(b, keys, before)
            starts = np.flatnonzero(new)
            place = np.arange(1, b.num_rows + 1)
            own = np.zeros(b.num_rows, np.int64)
            own[starts] = place[starts] - 1
            own = np.maximum.accumulate(own)
            run = starts[0] if len(starts) else b.num_rows      # rows that continue the key before
            seq = place - own
            seq[:run] = place[:run] + n
            cols, names = [*b.columns, pa.array(seq)], [*b.schema.names, LSEQ]
            for c in sums:
                total = _running(_values(b.column(c), 0), new, last_sum.get(c), np.add)
                last_sum[c] = total[-1]
                cols.append(pa.array(total, b.column(c).type))
                names.append(_lsum(c))
            for c in maxes:
                whole = pa.types.is_integer(b.column(c).type)
                none = LEAST_LONG if whole else -np.inf
                col = b.column(c).cast(pa.int64()) if whole else b.column(c).cast(pa.float64())
                top = _running(_values(col, none), new, last_max.get(c), np.maximum)
                last_max[c] = top[-1]
                cols.append(pa.array(top, mask=top == none))
                names.append(_lmax(c))
            for c in lags:
                col = b.column(c)
                prev = pa.concat_arrays([pa.array([last_value.get(c)], col.type), col.slice(0, len(col) - 1)])
                cols.append(pc.if_else(pa.array(new), pa.scalar(None, col.type), prev))
                names.append(_llag(c))
                last_value[c] = col[-1].as_py()
            before, n = [b.column(k)[-1].as_py() for k in keys], int(seq[-1])
            edge = np.zeros(b.num_rows, np.int8)
            if first_open:
                stop = (starts[1] if len(starts) > 1 else b.num_rows) if not held else run
                edge[:stop] = 1
                first_open = stop == b.num_rows
            if held:
                yield edged(*held.pop())
            held.append((pa.RecordBatch.from_arrays(cols, names), edge))
        if held:
            batch, edge = held.pop()
            new = _starts(batch, keys, None)
            edge[np.flatnonzero(new)[-1]:] |= 2
            yield edged(batch, edge)

    return scan


def _sum_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    return T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()


def keyed_running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  sums: Sequence[str] = (), maxes: Sequence[str] = (), lags: Sequence[str] = (),
                  partitions: int | None = None, seq_col: str = "seq",
                  sum_prefix: str = "running_", max_prefix: str = "running_max_",
                  lag_prefix: str = "prev_") -> DataFrame:
    """Add ``seq`` (1-based position of the row within its key, in ``order``),
    ``running_<c>`` (sum of ``c`` over the key's rows up to this one),
    ``running_max_<c>`` (largest non-NULL ``c`` so far; NULL if none) and
    ``prev_<c>`` (``c`` of the key's row before; NULL on the first).

    ``order`` must make rows unique within a key (add an id as a last tie
    breaker). NULL keys are one key; NULL summands count as 0. Sums of integers
    are long, of decimals decimal(38) and of floats double; maxima of integers
    are long, others double.
    """
    keys, sums, maxes, lags = list(keys), list(sums), list(maxes), list(lags)
    spark = df.sparkSession
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    sort_cols = [F.col(k) for k in keys] + order_cols
    kinds = {c: df.schema[c].dataType for c in {*sums, *maxes, *lags}}
    wide = df.withColumns({c: F.col(c).cast(_sum_type(kinds[c])) for c in sums if c not in maxes and c not in lags})
    # Without an explicit count AQE may coalesce adjacent ranges of a small
    # input; coalesced partitions are still contiguous, ordered ranges.
    ranged = (wide.repartitionByRange(partitions, *sort_cols) if partitions
              else wide.repartitionByRange(*sort_cols))
    ranged = ranged.sortWithinPartitions(*sort_cols).withColumn(PID, F.spark_partition_id())
    max_type = {c: T.LongType() if isinstance(kinds[c], T.IntegralType) else T.DoubleType() for c in maxes}
    schema = T.StructType(
        list(ranged.schema.fields) + [T.StructField(LSEQ, T.LongType())]
        + [T.StructField(_lsum(c), _sum_type(kinds[c])) for c in sums]
        + [T.StructField(_lmax(c), max_type[c]) for c in maxes]
        + [T.StructField(_llag(c), ranged.schema[c].dataType) for c in lags] + [T.StructField(EDGE, T.ByteType())])
    path = shared_dir(spark, "keyed-running")
    remove_at_end(spark, path)
    ranged.mapInArrow(_local_scan(keys, sums, maxes, lags), schema).write.mode("overwrite").parquet(path)
    local = spark.read.schema(schema).parquet(path)

    # Totals of the keys at a partition's ends only: at most two a partition.
    totals = local.where(F.col(EDGE) > 0).groupBy(PID, *keys).agg(
        F.max(LSEQ).alias("_n"), *[F.max_by(_lsum(c), LSEQ).alias(f"_s_{c}") for c in sums],
        *[F.max(_lmax(c)).alias(f"_m_{c}") for c in maxes], *[F.max_by(c, LSEQ).alias(f"_l_{c}") for c in lags])
    wk = Window.partitionBy(*keys).orderBy(PID)
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.select(F.col(PID).alias("_o_pid"), *[F.col(k).alias(f"_o_{k}") for k in keys],
                             F.sum("_n").over(before).alias("_off_n"),
                             *[F.sum(f"_s_{c}").over(before).alias(f"_off_{c}") for c in sums],
                             *[F.max(f"_m_{c}").over(before).alias(f"_offm_{c}") for c in maxes],
                             *[F.lag(f"_l_{c}").over(wk).alias(f"_offl_{c}") for c in lags])
               .where(F.col("_off_n").isNotNull()))
    # At most 2 rows per range partition: safe to broadcast whatever the data size.
    cond = [F.col(PID) == F.col("_o_pid")] + [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    joined = local.join(F.broadcast(offsets), cond, "left")
    out_cols = [F.col(c).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    out_cols.append((F.col(LSEQ) + F.coalesce(F.col("_off_n"), F.lit(0))).alias(seq_col))
    for c in sums:
        total = F.col(_lsum(c)) + F.coalesce(F.col(f"_off_{c}"), F.lit(0))
        out_cols.append(total.cast(_sum_type(kinds[c])).alias(f"{sum_prefix}{c}"))
    for c in maxes:
        # greatest() skips NULLs: either side may have seen no value yet.
        out_cols.append(F.greatest(F.col(_lmax(c)), F.col(f"_offm_{c}")).alias(f"{max_prefix}{c}"))
    for c in lags:
        # Only a continued key's first row in a partition takes the value from the partition before.
        out_cols.append(F.when(F.col(LSEQ) == 1, F.col(f"_offl_{c}")).otherwise(F.col(_llag(c))).alias(f"{lag_prefix}{c}"))
    return joined.select(*out_cols)
