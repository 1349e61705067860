"""JDBC sources and sinks.

Connection settings are options only; no credentials live in code. Reads of
large tables split on a numeric column (``partition_column``) so each task
reads one range; filters written on the DataFrame are pushed into the query.
Write errors fail the batch (the reference swallowed them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _opts(url: str, props: dict[str, str] | None) -> dict[str, str]:
    o = {"url": url}
    o.update(props or {})
    return o


def split_options(partition_column: str | None, lower: int | None, upper: int | None,
                  num_partitions: int | None) -> dict[str, str]:
    """Options by which Spark reads ranges of a numeric column as tasks of their own; rows beyond the
    bounds are in the first and last range. None without a column: one task."""
    if not partition_column:
        return {}
    if lower is None or upper is None:
        raise ValueError("a split read needs the column's bounds")
    return {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions or 8)}


def query_options(query: str, partition_column: str | None = None, lower: int | None = None,
                  upper: int | None = None, num_partitions: int | None = None) -> dict[str, str]:
    """What reads a query: as it is in one task, or as a derived table split by a column of its result."""
    split = split_options(partition_column, lower, upper, num_partitions)
    return {"dbtable": f"({query.strip().rstrip(';')}) split_query", **split} if split else {"query": query}


def read_table(spark: SparkSession, url: str, table: str, props: dict[str, str] | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A table as a DataFrame; add ``.where(...)`` and Spark pushes it down."""
    split = split_options(partition_column, lower, upper, num_partitions)
    return spark.read.format("jdbc").options(**_opts(url, props)).option("dbtable", table).options(**split).load()


def read_query(spark: SparkSession, url: str, query: str, props: dict[str, str] | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """The rows of a query; with a column of its result and bounds, read in ranges."""
    options = query_options(query, partition_column, lower, upper, num_partitions)
    return spark.read.format("jdbc").options(**_opts(url, props)).options(**options).load()


def query_as_json(spark: SparkSession, url: str, query: str, n: int | None = None,
                  props: dict[str, str] | None = None) -> DataFrame:
    """Rows as JSON objects keyed by column name (``limit n`` if given)."""
    df = read_query(spark, url, query, props)
    if n is not None:
        df = df.limit(n)
    return df.select(F.to_json(F.struct("*")).alias("json"))


def write_table(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None,
                mode: str = "append", batch_size: int = 1000,
                column_types: str | None = None) -> None:
    """K6: batch insert (``batchsize`` rows per statement batch).

    ``column_types`` (e.g. ``"id VARCHAR(20)"``) sets column types when the
    table is created, for databases whose default text type cannot be compared.
    """
    w = (df.write.format("jdbc").options(**_opts(url, props)).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    w.mode(mode).save()


def stream_to_table(stream: DataFrame, url: str, table: str, checkpoint: str,
                    props: dict[str, str] | None = None, trigger: dict | None = None):
    """K5: a stream appended to a JDBC table, one write per micro-batch."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        write_table(batch, url, table, props)
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def copy_table(spark: SparkSession, src_url: str, src_query: str, dst_url: str, dst_table: str,
               src_props: dict[str, str] | None = None,
               dst_props: dict[str, str] | None = None, column_types: str | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> None:
    """K8: JDBC source -> JDBC sink copy, in ranges if a column and bounds are given."""
    rows = read_query(spark, src_url, src_query, src_props, partition_column, lower, upper, num_partitions)
    write_table(rows, dst_url, dst_table, dst_props, column_types=column_types)
