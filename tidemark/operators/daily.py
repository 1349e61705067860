"""Daily PV / UV / live-viewing metrics.

The reference sends every record of the day to one task (``windowAll``) and
keeps a map of all users in state. Here the day is an ordinary grouping key:
the distinct count is planned by Catalyst as an aggregate on (day, user)
first, so the users of one day are spread over all shuffle partitions and
only small partial counts meet per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import DATETIME_FMT, DAY_WINDOW_START, local_text

# Fixed values of the reference's daily job.
PV_EVENT = "$AppStart"
LIVE_EVENT = "LiveVisit"
SECONDS_PER_BEAT = 3.0   # one live event stands for 3 s of viewing
SECONDS_PER_MINUTE = 60
METRICS = ("pv", "uv", "live_avg", "live_users")


def day_window(ts: str | Column = "ts") -> Column:
    """Tumbling 1-day event-time window that starts at local (UTC+8) midnight."""
    return F.window(ts, "1 day", "1 day", DAY_WINDOW_START)


def live_minutes(beats: Column, users: Column) -> Column:
    """Beats * 3.0 / users / 60, in this order so doubles match bit for bit."""
    return beats * F.lit(SECONDS_PER_BEAT) / users / F.lit(SECONDS_PER_MINUTE)


def daily_pv_uv(events: DataFrame, pv_event: str = PV_EVENT,
                user: str = "distinct_id", ts: str = "ts") -> DataFrame:
    """A6 + A7: (day, pv, uv) per local day for one event type."""
    return (events.where(F.col("event") == pv_event)          # P4, pushed to the scan
            .select(ts, user)                                  # P15
            .groupBy(day_window(ts).alias("w"))
            .agg(F.count(F.lit(1)).alias("pv"), F.count_distinct(user).alias("uv"))
            .select(local_text("w.start").alias("day"), "pv", "uv"))


def daily_live(events: DataFrame, live_event: str = LIVE_EVENT,
               user: str = "distinct_id", ts: str = "ts") -> DataFrame:
    """(day, live_users, live_avg minutes per user) for one event type."""
    agg = (events.where(F.col("event") == live_event)
           .select(ts, user)
           .groupBy(day_window(ts).alias("w"))
           .agg(F.count(F.lit(1)).alias("beats"), F.count_distinct(user).alias("live_users")))
    return agg.select(local_text("w.start").alias("day"), "live_users",
                      live_minutes(F.col("beats"), F.col("live_users")).alias("live_avg"))


def daily_metrics(events: DataFrame, pv_event: str = PV_EVENT, live_event: str = LIVE_EVENT,
                  user: str = "distinct_id", ts: str = "ts",
                  with_update_time: bool = False) -> DataFrame:
    """A10: tall (day, metric, value-as-text) rows for pv, uv, live_avg, live_users;
    with ``with_update_time`` also the write time text (F5), as the reference emits.

    One scan and one aggregation for both branches: grouping by (day, event)
    keeps a single distinct aggregate, so no Expand doubles the rows.
    """
    agg = (events.where(F.col("event").isin(pv_event, live_event))
           .select(ts, user, "event")
           .groupBy(day_window(ts).alias("w"), "event")
           .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(user).alias("u")))

    def pair(name: str, v: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), v.cast("string").alias("value"))

    rows = F.when(F.col("event") == pv_event,
                  F.array(pair("pv", F.col("n")), pair("uv", F.col("u")))).otherwise(
        F.array(pair("live_avg", live_minutes(F.col("n"), F.col("u"))),
                pair("live_users", F.col("u"))))
    out = agg.select(local_text("w.start").alias("day"), F.inline(rows))
    if with_update_time:
        out = out.withColumn("update_time", local_text(F.current_timestamp(), DATETIME_FMT))
    return out
