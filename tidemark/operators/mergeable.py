"""User-defined mergeable aggregates (U2, A4): create / add / merge / result.

An aggregate is a small object of four methods, as the reference's
``AggregateFunction`` has them, over an accumulator that can be written as bytes. It is run as

1. partial: every task folds its rows into one accumulator per key (``add``), in Arrow batches. If a
   task meets more than ``HELD`` keys it hands its accumulators on and begins anew;
2. merged by salted levels: accumulators are dealt by (key, task number // ``FANIN`` ** level) and
   merged one after the other as they stream in, so a key's accumulators, one or
   a few a task, never gather in one group before the last level, where
   there are at most tasks / ``FANIN`` ** (levels - 1);
3. ``result`` of each key's last accumulator.

Rows are shuffled never, accumulators ``levels`` times: a key that holds a third of the rows costs what others do.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANIN = 64
LEVELS = 2
HELD = 100_000           # accumulators a task holds before it hands them on


class MergeableAggregate(Protocol):
    """What an aggregate tells. ``add`` gets the values of several rows of one key as columns."""

    inputs: Sequence[str]        # the columns it reads
    output: str                  # the type of its result, as DDL

    def create(self) -> Any: ...

    def add(self, acc: Any, columns: Sequence[pa.Array]) -> Any: ...

    def merge(self, acc: Any, other: Any) -> Any: ...

    def result(self, acc: Any) -> Any: ...


class Count:
    """The reference's own: the number of rows."""

    inputs: Sequence[str] = ()
    output = "bigint"

    def create(self) -> int:
        return 0

    def add(self, acc: int, columns: Sequence[pa.Array]) -> int:
        return acc + len(columns[0])

    def merge(self, acc: int, other: int) -> int:
        return acc + other

    def result(self, acc: int) -> int:
        return acc


class TopK:
    """The ``k`` rows of the largest weights, as (weight, id), ties to the smaller id. Rows whose
    weight or id is null are left out."""

    def __init__(self, weight: str, ident: str, k: int):
        self.inputs, self.k = (weight, ident), k
        self.output = "array<struct<weight:double,id:bigint>>"

    def create(self) -> list:
        return []

    def _best(self, rows) -> list:
        return heapq.nsmallest(self.k, rows, key=lambda r: (-r[0], r[1]))

    def add(self, acc: list, columns: Sequence[pa.Array]) -> list:
        weight, ident = columns[:2]
        good = pc.and_(weight.is_valid(), ident.is_valid())
        table = pa.table({"w": pc.negate(weight.filter(good).cast(pa.float64())), "i": ident.filter(good).cast(pa.int64())})
        if not table.num_rows:      # Arrow selects nothing from no rows but with an error
            return acc
        first = pc.select_k_unstable(table, self.k, [("w", "ascending"), ("i", "ascending")])
        table = table.take(first)
        return self._best(acc + [(-w, i) for w, i in zip(table["w"].to_pylist(), table["i"].to_pylist())])

    def merge(self, acc: list, other: list) -> list:
        return self._best(acc + other)

    def result(self, acc: list) -> list:
        return [{"weight": w, "id": i} for w, i in acc]


class Histogram:
    """How many values fall in [low + i * width, low + (i + 1) * width); values below the first
    bin count in it, values beyond the last in the last one; null and NaN in none."""

    output = "array<bigint>"

    def __init__(self, value: str, low: float, width: float, bins: int):
        self.inputs, self.low, self.width, self.bins = (value,), low, width, bins

    def create(self) -> np.ndarray:
        return np.zeros(self.bins, np.int64)

    def add(self, acc: np.ndarray, columns: Sequence[pa.Array]) -> np.ndarray:
        values = columns[0].drop_null().cast(pa.float64()).to_numpy(zero_copy_only=False)
        values = values[~np.isnan(values)]
        place = np.clip(np.floor((values - self.low) / self.width), 0, self.bins - 1).astype(np.int64)
        return acc + np.bincount(place, minlength=self.bins)

    def merge(self, acc: np.ndarray, other: np.ndarray) -> np.ndarray:
        return acc + other

    def result(self, acc: np.ndarray) -> list[int]:
        return acc.tolist()


def _groups(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, its rows) of one batch."""
    table = pa.Table.from_batches([batch])
    codes = table.select(keys).append_column("_row", pa.array(np.arange(len(table))))
    for group in codes.group_by(keys, use_threads=False).aggregate([("_row", "list")]).to_pylist():
        yield tuple(group[k] for k in keys), table.take(pa.array(group["_row_list"]))


def _written(keys: list[str], kinds: list[pa.DataType], held: dict, part: int) -> pa.RecordBatch:
    """The accumulators as rows: keys, part, acc."""
    cols = [pa.array([k[i] for k in held], kind) for i, kind in enumerate(kinds)]
    cols += [pa.array([part] * len(held), pa.int64()), pa.array([pickle.dumps(a) for a in held.values()], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, [*keys, "part", "acc"])


def _partial(keys: list[str], agg: MergeableAggregate, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        held: dict[tuple, Any] = {}
        kinds = None
        for b in batches:
            kinds = [b.schema.field(k).type for k in keys]
            for key, rows in _groups(b, keys):
                if key not in held:
                    held[key] = agg.create()
                held[key] = agg.add(held[key], [rows[c].combine_chunks() for c in (agg.inputs or keys[:1])])
            if len(held) > most:
                yield _written(keys, kinds, held, part)
                held = {}
        if held:
            yield _written(keys, kinds, held, part)

    return run


def _merge(keys: list[str], agg: MergeableAggregate):
    # Spark sees by the annotations that it takes a group's batches one by one.
    def run(group: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc, kinds = None, None
        for b in batches:                        # one after the other: the group is never whole in memory
            kinds = [b.schema.field(k).type for k in keys]
            for x in b.column("acc"):
                other = pickle.loads(x.as_py())
                acc = other if acc is None else agg.merge(acc, other)
        key = tuple(x.as_py() for x in group[:len(keys)])
        yield _written(keys, kinds, {key: acc}, group[len(keys)].as_py())

    return run


def mergeable_agg(df: DataFrame, keys: Sequence[str], agg: MergeableAggregate, out: str = "result", fanin: int = FANIN,
                  levels: int = LEVELS, held: int = HELD) -> DataFrame:
    """(keys, ``out``) of every key: ``agg`` over its rows. NULL keys are keys."""
    keys = list(keys)
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("part", T.LongType()), T.StructField("acc", T.BinaryType())])
    accs = df.select(*keys, *[c for c in agg.inputs if c not in keys]).mapInArrow(_partial(keys, agg, held), schema)
    for level in range(1, levels + 1):
        salt = F.lit(0).cast("bigint") if level == levels else F.floor(F.col("part") / F.lit(fanin)).cast("bigint")
        accs = accs.withColumn("part", salt).groupBy(*keys, "part").applyInArrow(_merge(keys, agg), schema)

    result = T.StructType([df.schema[k] for k in keys] + T._parse_datatype_string(f"`{out}` {agg.output}").fields)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = to_arrow_type(result[out].dataType)
        for b in batches:
            found = [agg.result(pickle.loads(x.as_py())) for x in b.column("acc")]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.array(found, kind)], [*keys, out])

    return accs.mapInArrow(finish, result)

