"""Lookup of a stream in a table that changes while the stream runs.

The reference asks a database for each record as it passes, so a record sees the
dimension of its moment. Here every micro-batch reads the dimension's newest
version when it starts, and pins it: the version's number is written beside the output under the
batch's id before the batch is joined. A batch that is run again after a failure finds
its pin and joins the same version, so its rows are the same, whatever
was published meanwhile.

The join is a left outer one on a dimension with one row a key (first by order wins). Only
keys that the batch has are taken from the dimension, and each in ``SALTS`` copies, so
that a key that a third of the records ask for is spread over as many tasks:
micro-batches run without adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.session import hadoop_path
from tidemark.sinks import snapshot

SALTS = 16


def publish(dim: DataFrame, path: str) -> int:
    """Make ``dim`` the table's newest version; returns its number."""
    return snapshot.replace(dim, path)


def pin(spark: SparkSession, dim_path: str, pins: str, batch_id: int) -> int:
    """The dimension's version of a batch: as pinned before, else the newest one. A version is kept for
    ``snapshot.KEEP_SECONDS`` after the next one: set that to more than an outage lasts."""
    versions = snapshot.committed_versions(spark, dim_path)
    if not versions:
        raise ValueError(f"no version of the dimension has been published at {dim_path}")
    version = versions[-1]
    if snapshot._take(spark, pins, batch_id, {"version": version}):
        return version
    return next(snapshot._entry(spark, st)["version"] for n, st in snapshot._log(spark, pins) if n == batch_id)


def looked_up(records: DataFrame, dim: DataFrame, key: str, value: str, order: str, default: str = joins.NO_MATCH,
              out: str | None = None, salts: int = SALTS) -> DataFrame:
    """Records with ``value`` of the dimension's first row by ``order``; no row or no key: ``default``."""
    asked = records.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    one = joins.dedup_dimension(dim.join(asked, F.col(key) == F.col("_k"), "left_semi"), key, value, order)
    spread = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = records.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    # The salt is part of the key, so that the rows of one key meet in different tasks.
    found = spread.withColumn("_hit", F.lit(True)).withColumnRenamed(value, "_value")
    joined = salted.join(found, [key, "_salt"], "left")
    return joined.withColumn(out or value, F.when(F.col("_hit"), F.col("_value")).otherwise(F.lit(default))).drop(
        "_salt", "_hit", "_value")


def lookup_sink(dim_path: str, out: str, key: str, value: str, order: str, default: str = joins.NO_MATCH,
                renamed: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: enriched records under ``out``/rows/batch=<id>, a repeated batch
    replaces its own folder; pins under ``out``/pins."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = pin(spark, dim_path, f"{out}/pins", batch_id)
        rows = looked_up(batch, snapshot.read_version(spark, dim_path, version), key, value, order, default, renamed)
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
    return write


def read_looked_up(spark: SparkSession, out: str) -> DataFrame | None:
    """All batches' rows, with their ``batch``."""
    fs, p = hadoop_path(spark, f"{out}/rows")
    return spark.read.parquet(f"{out}/rows") if fs.exists(p) else None
