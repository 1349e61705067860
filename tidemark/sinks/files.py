"""Day-bucketed file sinks (K1, K2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import local_text_from_ms

# Fixed value: bucket for records whose time is missing or not a number.
INVALID_BUCKET = "__invalid__"


def day_bucket(time_ms_text: Column) -> Column:
    """Bucket id = local day ``yyyy-MM-dd`` of the record's epoch-ms time."""
    ms = time_ms_text.try_cast("bigint")
    return F.when(ms.isNull(), F.lit(INVALID_BUCKET)).otherwise(local_text_from_ms(ms))


def with_day_bucket(records: DataFrame, time_path: str = "$.time", value: str = "value") -> DataFrame:
    """Add ``dt`` from the JSON member ``time`` of the record's value."""
    return records.withColumn("dt", day_bucket(F.get_json_object(F.col(value), time_path)))


def _dealt(records: DataFrame) -> DataFrame:
    """Rows dealt by day, so that a day is written by few tasks and not by all;
    REBALANCE splits a large day by the size seen at run time and joins small ones."""
    return records.hint("rebalance", "dt")


def write_day_json(records: DataFrame, path: str, mode: str = "append") -> None:
    """K1 (batch): JSON files under ``dt=<day>/``, one object per line."""
    _dealt(records).write.mode(mode).partitionBy("dt").json(path)


def write_day_text(records: DataFrame, path: str, value: str = "value", mode: str = "append") -> None:
    """K2 (batch): the same bucketing, written as lines of text."""
    _dealt(records.select(value, "dt")).write.mode(mode).partitionBy("dt").text(path)


def day_json_stream(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """K1 (stream): file sink with exactly-once commit log per micro-batch."""
    w = (records.writeStream.format("json").partitionBy("dt")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()
