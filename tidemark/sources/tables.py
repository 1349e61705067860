"""Readers for the parquet tables and the logical clickstream view over them.

The logical schemas of the reference (clickstream event, live visit, user
behaviour, sensor reading) are mapped onto the driver's ``events`` table:

* event = ``event_type``; user = ``user_id`` (``distinct_id`` is its text form)
* item / message id = ``props.k``; title = ``'room-' || k``
* temperature / amount = ``value``; order = (``ts``, ``event_id``)

Columns are selected lazily, so Catalyst prunes the scan to what a query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import ntz_micros
from tidemark.session import pin_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed value: title prefix used to give each message id a title.
TITLE_PREFIX = "room-"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clickstream(events: DataFrame) -> DataFrame:
    """events -> clickstream columns with an event-time ``ts`` (TIMESTAMP)."""
    us = ntz_micros("ts")
    k = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        F.col("event_type").alias("event"),
        "user_id",
        F.col("user_id").cast("string").alias("distinct_id"),
        k.alias("message_id"),
        k.cast("bigint").alias("item_id"),
        F.concat(F.lit(TITLE_PREFIX), k).alias("title"),
        "value",
        "props",
        F.timestamp_micros(us).alias("ts"),
        F.floor(us / F.lit(1000)).cast("bigint").alias("time_ms"),
        us.alias("time_us"),
    )


def read_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream view."""
    return clickstream(read_table(spark, sf_dir, "events"))
