"""Kafka sources and record decoding.

The reader needs the Kafka connector package on the cluster; decoding works
on any DataFrame with Kafka's columns (key, value, topic, partition, offset,
timestamp), so tests replay such rows from files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA_COLUMNS = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Fixed text of the reference's lineage line (topic, partition, offset).
LINEAGE_FORMAT = "消费的主题是：%s,分区是：%s,当前偏移量是：%s"


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               streaming: bool = True, starting_timestamp: int | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """S1 + S2: a topic as a (streaming) DataFrame.

    ``starting`` is ``latest`` or ``earliest``; ``starting_timestamp`` (epoch
    ms) starts from a time. Committed group offsets are not used: Spark keeps
    positions in the query checkpoint, which is what makes restarts exact.
    """
    r = spark.readStream if streaming else spark.read
    r = r.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if starting_timestamp is not None:
        r = r.option("startingTimestamp", str(starting_timestamp))
    else:
        r = r.option("startingOffsets", starting)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def as_strings(records: DataFrame) -> DataFrame:
    """The value as UTF-8 text (``SimpleStringSchema``)."""
    return records.select(F.col("value").cast("string").alias("value"))


def is_json(text: Column) -> Column:
    """Whether ``text`` is one JSON value. A tree reader keeps the last of
    members with one name, which ``try_parse_json`` refuses; ``get_json_object``
    reads such a text, so it is the second opinion."""
    return F.try_parse_json(text).isNotNull() | F.get_json_object(text, "$").isNotNull()


def decode_key_value(records: DataFrame, include_metadata: bool = True) -> DataFrame:
    """S3 + S4: (key, value, metadata) with key and value as JSON text.

    Tolerant like the reference: a NULL key or value is just left out; a
    malformed part is NULL and so is every later part (order key, value,
    metadata), because decoding stops at the first error. ``decode_ok`` is
    false for such records so callers can quarantine them.
    """
    k, v = F.col("key").cast("string"), F.col("value").cast("string")
    key_ok = k.isNull() | is_json(k)
    value_ok = v.isNull() | is_json(v)
    cols = [F.when(key_ok, k).alias("key"), F.when(key_ok & value_ok, v).alias("value")]
    if include_metadata:
        meta = F.struct(F.col("offset").alias("offset"), F.col("topic").alias("topic"),
                        F.col("partition").alias("partition"))
        cols.append(F.when(key_ok & value_ok, meta).alias("metadata"))
    cols.append((key_ok & value_ok).alias("decode_ok"))
    return records.select(*cols)


def node_text(value: Column, path: str) -> Column:
    """``node.get(a).get(b).asText()``: a scalar as it is written, "null" for a
    JSON null, "" for an object or array, NULL for a missing member. Of members
    with one name the last counts."""
    parent, _, name = path.rpartition(".")
    inner = F.get_json_object(value, parent) if parent != "$" else value

    def last(kind: str) -> Column:
        found = F.filter(F.map_entries(F.from_json(inner, f"map<string,{kind}>")), lambda e: e["key"] == name)
        return F.try_element_at(found, F.lit(-1))["value"]

    kind = F.coalesce(F.schema_of_variant(last("variant")), F.lit("VOID"))
    text = (F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(""))
            .otherwise(F.coalesce(last("string"), F.lit("null"))))
    # A member whose value is null has a key, a missing one has none.
    return F.when(F.array_contains(F.json_object_keys(inner), name), text)


def lineage(meta: str = "metadata") -> Column:
    """The reference's lineage line built from the record metadata (NULL without)."""
    line = F.format_string(LINEAGE_FORMAT, F.col(f"{meta}.topic"), F.col(f"{meta}.partition").cast("string"),
                           F.col(f"{meta}.offset").cast("string"))
    return F.when(F.col(meta).isNotNull(), line)


def guarded_fields(value: Column) -> list[Column]:
    """P10 on a decoded record value: (id, username, password), defaults
    "0", "null", "null"; a missing field stops the reading, earlier ones stay.
    A member that is JSON null is there: its text is "null"."""
    i, u, p = (node_text(value, f"$.{n}") for n in ("id", "username", "password"))
    has_i = i.isNotNull()
    has_u = has_i & u.isNotNull()
    has_p = has_u & p.isNotNull()
    return [F.when(has_i, i).otherwise(F.lit("0")).alias("id"),
            F.when(has_u, u).otherwise(F.lit("null")).alias("username"),
            F.when(has_p, p).otherwise(F.lit("null")).alias("password")]
