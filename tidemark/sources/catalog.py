"""Catalog tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, hadoop_path


def _version(df: DataFrame, spec: str) -> str:
    """A digest of how the rows are made (the analyzed plan, without its running
    numbers) and of the input files' paths, sizes and times, one listing a folder."""
    spark = df.sparkSession
    plan = re.sub(r"#\d+L?|plan_id=\d+", "", df._jdf.queryExecution().analyzed().toString())
    h = hashlib.sha256(f"{spec}|{plan}".encode())
    for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        fs, p = hadoop_path(spark, folder)
        h.update("|".join(sorted(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}" for st in fs.listStatus(p))).encode())
    return h.hexdigest()[:16]


def derived_table(df: DataFrame, name: str, form: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` in format ``form`` once per version of its input and of its
    plan, in the shared checkpoint folder, and return the folder.

    It is written beside its place and moved there, so two drivers that build it
    at once do not mix their files: the first one's folder stays.
    """
    spark = df.sparkSession
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    path = f"{base}/derived/{name}-{_version(df, f'{name}|{form}|{list(partition_by)}')}"
    fs, final = hadoop_path(spark, path)
    if not fs.exists(final):
        tmp = f"{path}.{spark.sparkContext.applicationId}.tmp"
        df.write.mode("overwrite").format(form).partitionBy(*partition_by).save(tmp)
        _, made = hadoop_path(spark, tmp)
        if fs.exists(final) or not fs.rename(made, final):
            fs.delete(made, True)
    return path


def register_partitioned(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register parquet files laid out as ``<col>=<value>/`` folders as a
    catalog table and discover its partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def scan_partition(spark: SparkSession, name: str, predicate: str,
                   limit: int | None = None) -> DataFrame:
    """S14 + T3: catalog scan with a partition predicate (pruned at planning)
    and an optional LIMIT without order."""
    df = spark.table(name).where(F.expr(predicate))
    return df.limit(limit) if limit is not None else df
