"""Run streaming queries to completion over a finite input (file replay).

``availableNow`` processes everything present at start in bounded micro-batches
and stops. Checkpoints and outputs go to fresh folders
under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import hadoop_path, remove_at_end, shared_dir


# Bytes of the input a replayed file holds, and files a trigger takes at most by core.
FILE_BYTES = 64 << 20


def _pieces(df: DataFrame, least: int = 1) -> int:
    """How many files ``df`` is written as, by the size Spark estimates for it (rows given
    by the driver have none: Spark says the largest number there is)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 62:
        size = 0
    return min(max(least, -(-size // FILE_BYTES)), 1_000_000)


def replay(spark: SparkSession, events: DataFrame, after: Sequence[DataFrame] = (), parts: int = 5,
           at: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """``events`` as a stream of files in the order of ``at``, at least ``parts`` of them and
    each of about ``FILE_BYTES``, then the files of each of ``after``. A trigger takes a
    ``parts``-th of the files, at most one a core, so its size is bounded and
    the order of the rows over micro-batches is the same on every run."""
    path = shared_dir(spark, "replay")
    remove_at_end(spark, path)
    fs, folder = hadoop_path(spark, path)
    names: list[str] = []

    def written(rows: DataFrame, pieces: int) -> None:
        cols = [F.col(c) for c in at if c in rows.columns] or [F.col(rows.columns[0])]
        ordered = rows.repartitionByRange(pieces, *cols).sortWithinPartitions(*cols)
        ordered.select(*[c for c in rows.columns if not c.startswith("_")]).write.mode("append").parquet(path)
        every = sorted(st.getPath().getName() for st in fs.listStatus(folder))
        names.extend(n for n in every if n.startswith("part-") and n not in known)
        known.update(names)

    known: set[str] = set()
    pieces = _pieces(events, parts)
    written(events, pieces)
    for rows in after:
        written(rows, _pieces(rows))
    for i, name in enumerate(names):      # the file source goes by modification time
        fs.setTimes(hadoop_path(spark, f"{path}/{name}")[1], 1_000_000_000_000 + 1000 * i, -1)
    schema = events.select(*[c for c in events.columns if not c.startswith("_")]).schema
    at_once = max(1, min(spark.sparkContext.defaultParallelism, pieces // parts))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(at_once)).parquet(path)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Start streaming queries with ``n`` shuffle (= state) partitions and the
    RocksDB state store.

    A stateful query keeps the partition count and state store of its first
    run for the life of its checkpoint, so both are chosen here on purpose --
    the cluster's default parallelism unless given, and RocksDB (state off the
    JVM heap; required by transformWithState) -- instead of inheriting the
    session's batch settings. A query reads the settings when it starts; the
    session's values are restored afterwards.
    """
    conf = {"spark.sql.shuffle.partitions": str(n or spark.sparkContext.defaultParallelism),
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def await_done(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for the query's own end, or for ``timeout_s`` seconds if given."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"streaming query {q.name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


def run_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], mode: str,
                      checkpoint: str | None = None, name: str = "q",
                      timeout_s: int | None = None) -> str:
    """Run ``stream`` with ``foreachBatch(fn)`` until the input is drained."""
    spark = stream.sparkSession
    ck = checkpoint or shared_dir(spark, f"ckpt-{name}")
    with state_partitions(spark):
        q = (stream.writeStream.outputMode(mode).foreachBatch(fn)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
    await_done(q, timeout_s)
    return ck


def run_processing_time(stream: DataFrame, fn: Callable[[DataFrame, int], None], mode: str,
                        checkpoint: str | None = None, name: str = "q", timeout_s: int = 600) -> str:
    """Run ``stream`` under a processing-time trigger until a trigger finds no new input, then stop
    it: a query with state by the clock has a next trigger for ever, so neither ``availableNow``
    nor ``processAllAvailable`` ends."""
    spark = stream.sparkSession
    ck = checkpoint or shared_dir(spark, f"ckpt-{name}")
    with state_partitions(spark):
        q = (stream.writeStream.outputMode(mode).foreachBatch(fn)
             .option("checkpointLocation", ck).trigger(processingTime="1 second").start())
    end = time.monotonic() + timeout_s
    try:
        while not any(p["numInputRows"] == 0 for p in q.recentProgress):
            if q.exception() is not None:
                raise q.exception()
            if time.monotonic() > end:
                raise TimeoutError(f"streaming query {name} did not finish in {timeout_s}s")
            time.sleep(0.2)
    finally:
        q.stop()
    return ck


def run_foreach_batches(jobs: list[tuple[DataFrame, Callable[[DataFrame, int], None], str, str]],
                        timeout_s: int | None = None) -> list[str]:
    """Start several (stream, foreachBatch fn, output mode, name) queries
    together, then wait for all of them; returns their checkpoints."""
    started, cks = [], []
    for stream, fn, mode, name in jobs:
        spark = stream.sparkSession
        ck = shared_dir(spark, f"ckpt-{name}")
        with state_partitions(spark):
            started.append(stream.writeStream.outputMode(mode).foreachBatch(fn)
                           .option("checkpointLocation", ck).trigger(availableNow=True).start())
        cks.append(ck)
    for q in started:
        await_done(q, timeout_s)
    return cks


def run_to_parquet(stream: DataFrame, mode: str = "append", name: str = "q",
                   timeout_s: int | None = None) -> DataFrame:
    """Append-mode stream -> parquet file sink (exactly once) -> batch DataFrame."""
    spark = stream.sparkSession
    out = shared_dir(spark, f"out-{name}")
    ck = shared_dir(spark, f"ckpt-{name}")
    with state_partitions(spark):
        q = (stream.writeStream.outputMode(mode).format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
    await_done(q, timeout_s)
    return spark.read.schema(stream.schema).parquet(out)
