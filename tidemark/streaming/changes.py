"""A count that changes, as a changelog, and the table that follows it.

The reference prints the changes of an updating count: (false, old row), (true, new row).
Here a processor makes them, one pair a key and trigger, and a sink applies them to a
bucketed table, once per trigger, whatever is repeated after a failure.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.sinks import bucketed

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class CountChanges(StatefulProcessor):
    """(false, old count) and (true, new count) of a key at every trigger that has rows of it."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "c bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = self.count.get()[0] if self.count.exists() else 0
        new = old + sum(int(pdf["n"].sum()) for pdf in rows)
        self.count.update((new,))
        pair = [(False, old), (True, new)] if old else [(True, new)]
        yield pd.DataFrame({self.key: [key[0]] * len(pair), "is_add": [p[0] for p in pair], "cnt": [p[1] for p in pair]})

    def close(self) -> None:
        pass


def count_changes(rows: DataFrame, key: str) -> DataFrame:
    """Update-mode (key, is_add, cnt): the changelog of the number of rows a key has. Rows
    are counted by key in the task that reads them, so a frequent key is a few rows in the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).append_column("n", pa.array([1] * b.num_rows, pa.int64()))
            yield from (t.group_by([key]).aggregate([("n", "sum")]).select([key, "n_sum"])
                        .rename_columns([key, "n"]).to_batches())

    kind = rows.schema[key]
    counted = rows.select(key).mapInArrow(run, T.StructType([kind, T.StructField("n", T.LongType())]))
    return counted.groupBy(key).transformWithStateInPandas(
        CountChanges(key), T.StructType([kind, T.StructField("is_add", T.BooleanType()), T.StructField("cnt", T.LongType())]),
        "update", "None")


def table_sink(path: str, key: str, buckets: int = bucketed.BUCKETS):
    """foreachBatch function: applies a changelog to the (key, cnt) table at ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        bucketed.apply_changes(batch, path, batch_id, key, buckets=buckets)
    return write
