"""Keyed snapshot tables in hash buckets: an upsert rewrites only the buckets it changes.

The table is a log of commits as in :mod:`tidemark.sinks.snapshot`. An entry is a manifest:
for every bucket of the keys' hash the folder that holds it now, and the last batch id of
every writer. An upsert

1. reads the buckets that the batch's keys hash to and merges the rows into them;
2. writes new folders for those buckets in which some row changed, and no others;
3. commits a manifest with these folders in place of the old ones.

Of two writers that commit at once one comes second. If the other one has replaced none of its
buckets, its folders hold on top of the other's manifest and it commits them under the next
number; only if they met in a bucket does it merge anew. So writers on different
keys do not wait for each other, and none loses a row.

The number of buckets is chosen when the table is made: a bucket should fit one task. What the
driver holds is the manifest, one line a bucket, and the numbers of the buckets met.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import hadoop_path
from tidemark.sinks import snapshot

BUCKETS = 64
BUCKET = "_bucket"
CHANGED = "_changed"     # a row that is new or differs from the stored one
GONE = "_gone"           # a row that is stored no more: it says that its bucket changed


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame | None:
    return spark.read.parquet(*[f"{path}/{f}" for f in folders]) if folders else None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest commit's rows; None before the first row."""
    _, entry = snapshot._newest(spark, path)
    return _read(spark, path, list(entry["files"].values())) if entry else None


def read_key(spark: SparkSession, path: str, key: str, key_value: str) -> DataFrame | None:
    """The row of one text key, from its bucket alone."""
    _, entry = snapshot._newest(spark, path)
    if not entry:
        return None
    bucket = spark.range(1).select(bucket_of(F.lit(key_value), entry["buckets"])).first()[0]
    folder = entry["files"].get(str(bucket))
    rows = _read(spark, path, [folder] if folder else list(entry["files"].values())[:1])
    return rows.where(F.col(key) == F.lit(key_value)) if rows is not None else None


def _drop_old(spark: SparkSession, path: str) -> None:
    """Folders that a commit older than ``KEEP_SECONDS`` replaced go, and the commits before it."""
    log = snapshot._log(spark, path)
    old = (time.time() - snapshot.KEEP_SECONDS) * 1000
    for (_, status), (_, after) in zip(log, log[1:]):
        if after.getModificationTime() >= old:
            break
        still = set(snapshot._entry(spark, after)["files"].values())
        for folder in set(snapshot._entry(spark, status)["files"].values()) - still:
            fs, p = hadoop_path(spark, f"{path}/{folder}")
            fs.delete(p, True)
        fs, _ = hadoop_path(spark, path)
        fs.delete(status.getPath(), False)


def upsert(batch: DataFrame, path: str, batch_id: int, key: str, merge: Callable[[DataFrame, DataFrame | None], DataFrame],
           buckets: int = BUCKETS, writer: str | None = None) -> list[int]:
    """Merge ``batch`` into the table at ``path`` once per (writer, ``batch_id``); returns the
    buckets that were rewritten.

    ``merge`` takes the batch and the stored rows of its buckets (None if there are none), both with a ``BUCKET``
    column, and returns the buckets' whole new rows with ``BUCKET`` and the booleans ``CHANGED`` and ``GONE``.
    Grouping by (BUCKET, key) needs no more shuffles: rows come dealt by bucket.
    """
    spark = batch.sparkSession
    who = snapshot._writer(spark, writer)
    number, entry = snapshot._newest(spark, path)
    if entry and entry["writers"].get(who) == batch_id:
        snapshot.drained(batch)
        return []
    n = entry["buckets"] if entry else buckets
    rows = batch.withColumn(BUCKET, bucket_of(key, n)).persist()
    try:
        met = sorted(str(r[0]) for r in rows.select(BUCKET).distinct().collect())      # at most n numbers
        if not met:
            return []
        while True:
            data, changed = _merged(spark, path, rows, entry, met, key, n, merge)
            while True:
                files = {b: f for b, f in (entry["files"] if entry else {}).items() if b not in changed}
                files |= {b: f"{data}/{BUCKET}={b}" for b, kept in changed.items() if kept}
                writers = (dict(entry["writers"]) if entry else {}) | {who: batch_id}
                if snapshot._take(spark, path, number + 1, {"buckets": n, "files": files, "writers": writers}):
                    _drop_old(spark, path)
                    return [int(b) for b in changed]
                before = entry["files"] if entry else {}
                number, entry = snapshot._newest(spark, path)
                if entry["writers"].get(who) == batch_id:       # another attempt of this batch was first
                    _delete(spark, f"{path}/{data}")
                    return []
                if entry["buckets"] != n:
                    raise ValueError(f"{path} has {entry['buckets']} buckets, not {n}")
                if any(entry["files"].get(b) != before.get(b) for b in met):
                    break
            _delete(spark, f"{path}/{data}")
    finally:
        rows.unpersist()


def _merged(spark: SparkSession, path: str, rows: DataFrame, entry: dict | None, met: list[str], key: str, n: int,
            merge) -> tuple[str, dict[str, int]]:
    """Write the buckets that change; (their folder, how many rows each has)."""
    current = _read(spark, path, [entry["files"][b] for b in met if b in entry["files"]] if entry else [])
    if current is not None:
        current = current.withColumn(BUCKET, bucket_of(key, n)).repartition(BUCKET)
    new = merge(rows.repartition(BUCKET), current).persist()
    data = f"data-{uuid.uuid4().hex}"
    try:
        # At most n rows.
        told = new.groupBy(BUCKET).agg(F.max(CHANGED).alias("c"), F.count_if(~F.col(GONE)).alias("kept")).where("c").collect()
        changed = {str(r[BUCKET]): r["kept"] for r in sorted(told)}
        if any(changed.values()):
            (new.where(F.col(BUCKET).isin([int(b) for b in changed]) & ~F.col(GONE)).drop(CHANGED, GONE)
             .write.partitionBy(BUCKET).parquet(f"{path}/{data}"))
        return data, changed
    finally:
        new.unpersist()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def upsert_keep_max(batch: DataFrame, path: str, batch_id: int, key: str = "row_key", value: str = "uv",
                    buckets: int = BUCKETS, writer: str | None = None) -> list[int]:
    """K3: store ``value`` for a key only if it is larger than the stored one; a key
    that is not stored is stored. Returns the buckets that were rewritten."""
    def merge(rows: DataFrame, current: DataFrame | None) -> DataFrame:
        none = F.lit(None).cast("bigint")
        new = rows.select(BUCKET, key, F.col(value).cast("bigint").alias(value), none.alias("_old"))
        if current is not None:
            new = new.unionByName(current.select(BUCKET, key, none.alias(value), F.col(value).alias("_old")))
        best = F.greatest(value, "_old")
        return (new.groupBy(BUCKET, key).agg(F.max(value).alias(value), F.max("_old").alias("_old"))
                .select(key, best.alias(value), F.lit(snapshot.MAX_ONLINE_DEFAULT).alias("max_online"), BUCKET,
                        (F.col("_old").isNull() | (best > F.col("_old"))).alias(CHANGED), F.lit(False).alias(GONE)))

    return upsert(batch, path, batch_id, key, merge, buckets, writer)


def apply_changes(batch: DataFrame, path: str, batch_id: int, key: str = "key", count: str = "cnt", is_add: str = "is_add",
                  buckets: int = BUCKETS, writer: str | None = None) -> list[int]:
    """A1 + X12: apply a retract changelog, (false, old row) and (true, new row), to the
    table of (key, count) rows. A row is there as often as it was added more than retracted, so the
    order of the pairs within a batch does not matter."""
    def merge(rows: DataFrame, current: DataFrame | None) -> DataFrame:
        def told(times: Column, is_new: bool) -> list[Column]:
            return [F.col(BUCKET), F.col(key), F.col(count), times.cast("bigint").alias("_times"), F.lit(is_new).alias(CHANGED)]

        new = rows.select(*told(F.when(F.col(is_add), 1).otherwise(-1), True))
        if current is not None:
            new = new.unionByName(current.select(*told(F.lit(1), False)))
        found = new.groupBy(BUCKET, key, count).agg(F.sum("_times").alias("_times"), F.max(CHANGED).alias(CHANGED))
        again = F.sequence(F.lit(1).cast("bigint"), F.greatest("_times", F.lit(1)))
        return found.select(BUCKET, key, count, CHANGED, (F.col("_times") < 1).alias(GONE), F.explode(again)).drop("col")

    return upsert(batch, path, batch_id, key, merge, buckets, writer)
