"""File and socket sources (S6-S10) and the CSV line parser.

Every reader takes an explicit schema: no inference pass over the data, and
the same code serves ``read`` (batch) and ``readStream`` (file streams).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The user-behaviour CSV, in the reference's explicit field order.
USER_BEHAVIOR = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("itemId", T.LongType()),
    T.StructField("categoryId", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# The sensor table DDL (id varchar(20) not null, timestamp bigint, temperature double).
SENSOR_DDL = "id STRING NOT NULL, timestamp BIGINT, temperature DOUBLE"
SENSOR_ID_MAX = 20


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             streaming: bool = False, **opts) -> DataFrame:
    """Typed CSV with an explicit field order."""
    r = _reader(spark, streaming).schema(schema)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.csv(path)


def read_sensor_table(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """``CREATE TABLE`` over CSV with a computed processing-time column.

    ``varchar(20) not null`` is enforced as a filter-and-flag rule: rows that
    break it get ``valid = false`` instead of failing the job.
    """
    df = read_csv(spark, path, SENSOR_DDL, streaming)
    ok = F.col("id").isNotNull() & (F.length("id") <= SENSOR_ID_MAX)
    return df.withColumn("valid", ok).withColumn("pt", F.current_timestamp())


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """A text file as a stream/table of lines (column ``value``)."""
    return _reader(spark, streaming).text(path)


def read_words(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Line file as one-column table ``word``: the text before the first comma
    (a CSV reader with one declared column keeps only the first field)."""
    return read_csv(spark, path, "word STRING", streaming)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket text stream (lines as ``value``). Not used in tests."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def parse_sensor_line(lines: DataFrame, line: str = "value") -> DataFrame:
    """P8: "id,timestamp,temperature" -> (id, timestamp, temperature).

    Split on commas, trim, cast with ``try_cast``; bad numbers become NULL
    (the reference throws) and ``valid`` flags them.
    """
    parts = F.split(F.col(line), ",")
    out = lines.select(
        F.trim(parts.getItem(0)).alias("id"),
        F.trim(parts.getItem(1)).try_cast("bigint").alias("timestamp"),
        F.trim(parts.getItem(2)).try_cast("double").alias("temperature"))
    return out.withColumn("valid", F.col("timestamp").isNotNull() & F.col("temperature").isNotNull())
