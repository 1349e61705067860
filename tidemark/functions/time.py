"""Time functions (F1, F2, event-time columns).

All of these are built-in column expressions, so they stay inside whole-stage
codegen and need no Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference's time rules.
# The reference shifts UTC to local time by a fixed +8 hours (28,800,000 ms) and
# cuts days at local midnight, i.e. 16:00 UTC.
LOCAL_SHIFT_HOURS = 8
LOCAL_OFFSET = "+08:00"
DAY_WINDOW_START = "16 hours"  # window(ts, '1 day', '1 day', '16 hours')
DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_micros(c) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ read as UTC wall-clock time.

    Independent of the session time zone (no cast through TIMESTAMP).
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, _c(c))


def epoch_ms_to_ts(c) -> Column:
    """Event-time attribute from epoch milliseconds (``.rowtime`` on a ms field)."""
    return F.timestamp_millis(_c(c))


def utc2local(ts) -> Column:
    """the reference's scalar function, a fixed +8 h shift (no DST rules)."""
    return _c(ts) + F.expr(f"INTERVAL {LOCAL_SHIFT_HOURS} HOURS")


def register_utc2local(spark: SparkSession) -> None:
    """Make ``utc2local`` callable from SQL as a SQL function (no Python UDF)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION utc2local(t TIMESTAMP) "
        f"RETURNS TIMESTAMP RETURN t + INTERVAL {LOCAL_SHIFT_HOURS} HOURS")


def local_text(ts, fmt: str = DATE_FMT) -> Column:
    """format an instant as text in the fixed local zone.

    The session zone is pinned to UTC, so shifting then formatting in UTC is
    the same as formatting in ``+08:00``.
    """
    return F.date_format(utc2local(ts), fmt)


def local_text_from_ms(ms, fmt: str = DATE_FMT) -> Column:
    return local_text(epoch_ms_to_ts(ms), fmt)
