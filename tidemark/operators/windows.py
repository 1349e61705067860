"""Keyed tumbling windows and window accessors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_bounds_ms(w: str = "w") -> list[Column]:
    """Window start / end as epoch milliseconds."""
    return [F.floor(F.unix_micros(F.col(f"{w}.start")) / F.lit(1000)).cast("bigint").alias("window_start"),
            F.floor(F.unix_micros(F.col(f"{w}.end")) / F.lit(1000)).cast("bigint").alias("window_end")]


def with_arrival_time(df: DataFrame, name: str = "arrival") -> DataFrame:
    """A processing-time column. On a stream it is the micro-batch time,
    so windows over it group records by when they were processed."""
    return df.withColumn(name, F.current_timestamp())


def keyed_window_count(events: DataFrame, keys: Sequence[str], size: str = "5 seconds",
                       time_col: str = "ts") -> DataFrame:
    """(keys, window_end, count) per tumbling window.

    W8: ``time_col`` picks the clock -- the event time column, or an arrival
    column (``current_timestamp()`` at ingest) for processing time (W3).
    """
    return (events.groupBy(F.window(time_col, size).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, window_bounds_ms()[1], "n"))


def min_by_window(events: DataFrame, keys: Sequence[str], by: str, size: str,
                  tie: Sequence[str], time_col: str = "ts") -> DataFrame:
    """Per tumbling window and key, the row with the smallest ``by``
    (compared as text), earliest ``tie`` first; with the window start.
    ``min_by`` is a partial aggregate: one row per group crosses the shuffle."""
    cols = [c for c in events.columns]
    best = F.min_by(F.struct(*cols), F.struct(F.col(by).cast("string"), *[F.col(t) for t in tie]))
    return (events.groupBy(F.window(time_col, size).alias("w"), *keys)
            .agg(best.alias("row"))
            .select(window_bounds_ms()[0], "row.*"))
