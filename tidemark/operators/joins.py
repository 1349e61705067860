"""Lookup enrichment."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: what the reference writes when the lookup finds no row.
NO_MATCH = "0000"


def dedup_dimension(dim: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the first by ``order`` wins. A map-side partial
    ``min_by`` keeps a duplicated hot key from piling up in one task."""
    return dim.groupBy(key).agg(F.min_by(F.col(value), F.col(order)).alias(value))


def enrich_lookup(stream: DataFrame, dim: DataFrame, key: str, value: str,
                  default: str = NO_MATCH, out: str | None = None) -> DataFrame:
    """Left outer equi-join of records to a de-duplicated dimension.

    No row -> ``default``; a found row whose value is NULL stays NULL (a match
    flag decides, not ``coalesce``). Works on batch and on streams
    (stream-static join). Spark chooses the join from the sizes it sees at run time.
    """
    d = dim.select(key, value).withColumn("_hit", F.lit(True))
    j = stream.join(d, on=key, how="left")
    return j.withColumn(out or value, F.when(F.col("_hit"), F.col(value)).otherwise(F.lit(default))) \
        .drop("_hit", *([value] if out and out != value else []))
