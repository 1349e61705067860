"""Keyed snapshot tables with keep-max (K3) and last-write (K4) rules; point read.

Without a table format that supports MERGE, a snapshot is a folder of data
folders and a log: ``_log/<n>.json`` names the data folder of commit n and the
last batch id of every writer. An upsert reads the newest commit, merges the
batch into it with an aggregate (no join: union + groupBy key), writes a new data
folder and then its log entry under the next number. An entry's name is taken
by a rename that fails if it exists, so of two writers one starts over from
the other's commit, and neither loses a row.

A writer is a streaming query (its id lives in its checkpoint) or a name given
by the caller. A batch is skipped only if its writer's last batch has the same id,
so a replay does not apply twice and a query with a new checkpoint, whose ids
start again, is not skipped. Old data folders go once they are both superseded
and older than ``KEEP_SECONDS``: a reader of the commit before still finds its files.

The snapshot holds one row per key (per key and metric for K4), so its size
follows the number of keys, not the number of events; every commit rewrites it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import hadoop_path

# Fixed value: the reference writes this constant next to the peak count.
MAX_ONLINE_DEFAULT = "0"
KEEP_SECONDS = 3600


def _log(spark: SparkSession, path: str) -> list[tuple[int, object]]:
    """(number, file status) of the log's entries, in order."""
    fs, p = hadoop_path(spark, f"{path}/_log")
    if not fs.exists(p):
        return []
    out = [(st.getPath().getName(), st) for st in fs.listStatus(p)]
    return sorted((int(name.split(".")[0]), st) for name, st in out if name.endswith(".json") and name[0].isdigit())


def _entry(spark: SparkSession, status) -> dict:
    fs, _ = hadoop_path(spark, status.getPath().toString())
    stream = fs.open(status.getPath())
    try:
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(raw)


def _newest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    log = _log(spark, path)
    return (log[-1][0], _entry(spark, log[-1][1])) if log else (0, None)


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    return [n for n, _ in _log(spark, path)]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    _, entry = _newest(spark, path)
    return spark.read.parquet(f"{path}/{entry['data']}") if entry else None


def read_version(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The rows of one commit; it is kept for ``KEEP_SECONDS`` after the next one."""
    entry = next(_entry(spark, st) for n, st in _log(spark, path) if n == number)
    return spark.read.parquet(f"{path}/{entry['data']}")


def replace(rows: DataFrame, path: str) -> int:
    """Commit ``rows`` as the whole table; returns the commit's number."""
    spark = rows.sparkSession
    data = f"data-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{data}")
    while True:
        number, entry = _newest(spark, path)
        if _take(spark, path, number + 1, {"data": data, "writers": entry["writers"] if entry else {}}):
            _drop_old(spark, path)
            return number + 1


def _take(spark: SparkSession, path: str, number: int, entry: dict) -> bool:
    """Write the log entry ``number``; false if another writer has it."""
    jvm = spark.sparkContext._jvm
    fs, tmp = hadoop_path(spark, f"{path}/_log/.{uuid.uuid4().hex}")
    fs.mkdirs(tmp.getParent())
    out = fs.create(tmp, True)
    out.write(json.dumps(entry).encode())
    out.close()
    _, final = hadoop_path(spark, f"{path}/_log/{number:010d}.json")
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(final), none)
        return True
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        fs.delete(tmp, False)
        return False


def _drop_old(spark: SparkSession, path: str) -> None:
    log = _log(spark, path)
    old = (time.time() - KEEP_SECONDS) * 1000
    for (_, status), (_, after) in zip(log, log[1:]):
        if after.getModificationTime() < old:
            fs, data = hadoop_path(spark, f"{path}/{_entry(spark, status)['data']}")
            fs.delete(data, True)
            fs.delete(status.getPath(), False)


def _writer(spark: SparkSession, writer: str | None) -> str:
    return writer or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def drained(batch: DataFrame) -> None:
    """Compute a batch that is not applied again: Spark wants the state of a repeated micro-batch
    committed all the same."""
    batch.write.format("noop").mode("overwrite").save()


def _upsert(batch: DataFrame, path: str, batch_id: int, writer: str | None,
            merge: Callable[[DataFrame, DataFrame | None], DataFrame]) -> None:
    spark = batch.sparkSession
    who = _writer(spark, writer)
    while True:
        number, entry = _newest(spark, path)
        writers = dict(entry["writers"]) if entry else {}
        if writers.get(who) == batch_id:
            return drained(batch)
        current = spark.read.parquet(f"{path}/{entry['data']}") if entry else None
        data = f"data-{uuid.uuid4().hex}"
        merge(batch, current).write.parquet(f"{path}/{data}")
        writers[who] = batch_id
        if _take(spark, path, number + 1, {"data": data, "writers": writers}):
            _drop_old(spark, path)
            return
        fs, p = hadoop_path(spark, f"{path}/{data}")
        fs.delete(p, True)


def keep_max_rows(peaks: DataFrame, row_key: Column, value: str) -> DataFrame:
    """K3 row shape: (row_key, value, max_online = "0")."""
    return peaks.select(row_key.alias("row_key"), F.col(value).cast("bigint").alias(value),
                        F.lit(MAX_ONLINE_DEFAULT).alias("max_online"))


def upsert_keep_max(batch: DataFrame, path: str, batch_id: int, key: str = "row_key",
                    value: str = "uv", writer: str | None = None) -> None:
    """K3: store ``value`` for a key only if it is larger than the stored one
    (a missing key counts as 0). Applied once per (writer, ``batch_id``)."""
    def merge(rows: DataFrame, current: DataFrame | None) -> DataFrame:
        new = rows.select(key, F.col(value).cast("bigint").alias(value))
        if current is not None:
            new = new.unionByName(current.select(key, value))
        return new.groupBy(key).agg(F.max(value).alias(value)).withColumn("max_online", F.lit(MAX_ONLINE_DEFAULT))

    _upsert(batch, path, batch_id, writer, merge)


def upsert_last_write(batch: DataFrame, path: str, batch_id: int, key: str = "day",
                      metric: str = "metric", value: str = "value",
                      written_at: str = "u_time", writer: str | None = None) -> None:
    """K4: per (key, metric) the newest value wins -- newest by (written_at,
    batch_id, value) so replays and ties resolve the same way every time."""
    def merge(rows: DataFrame, current: DataFrame | None) -> DataFrame:
        new = rows.select(key, metric, F.col(value).cast("string").alias(value),
                          F.col(written_at).cast("timestamp").alias(written_at),
                          F.lit(batch_id).cast("bigint").alias("batch_id"))
        if current is not None:
            new = new.unionByName(current)
        order = F.struct(written_at, "batch_id", value)
        return (new.groupBy(key, metric).agg(F.max_by(F.struct(value, written_at, "batch_id"), order).alias("r"))
                .select(key, metric, "r.*"))

    _upsert(batch, path, batch_id, writer, merge)


def pivot_metrics(tall: DataFrame, key: str, metrics: list[str], metric: str = "metric",
                  value: str = "value", written_at: str | None = "u_time") -> DataFrame:
    """Wide view of a K4 snapshot: one column per metric (+ latest write time)."""
    aggs = [F.max(F.when(F.col(metric) == m, F.col(value))).alias(m) for m in metrics]
    if written_at:
        aggs.append(F.max(written_at).alias(written_at))
    return tall.groupBy(key).agg(*aggs)


def point_read(snapshot: DataFrame, key: str, key_value, family: str = "info") -> DataFrame:
    """The cells of one row key as (row_key, family, qualifier, value)."""
    quals = [c for c in snapshot.columns if c != key]
    stacked = snapshot.where(F.col(key) == F.lit(key_value)).select(
        F.col(key).alias("row_key"),
        F.explode(F.array(*[F.struct(F.lit(q).alias("qualifier"),
                                     F.col(q).cast("string").alias("value")) for q in quals]))
        .alias("c"))
    return stacked.select("row_key", F.lit(family).alias("family"), "c.qualifier", "c.value")
