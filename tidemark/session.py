"""Session helpers.

The engine assumes a UTC session time zone: the driver tables store naive
timestamps that mean UTC, and every local-time rule (UTC+8 days, report
times) is written as an explicit fixed shift on top of UTC.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session built here gets. Shuffle partitions are a starting
# point only: AQE coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithStateInPandas requires the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """All time rules are written against UTC; make sure the session agrees."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: ``spark.checkpoint.dir`` when the
    cluster names one, else (local master only) a fresh local temp folder."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names shared storage every executor
    can reach. Only when it is unset (local tests) do we make one under the
    local temp folder and register it, so ``DataFrame.checkpoint()`` works too.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    path = f"{base}/{sub}-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder or file on whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder of intermediate rows removed when the application ends
    (a lazy result may be read until then)."""
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in executors' Python workers (used by
    ``mapInPandas`` and stateful processors): zip the package into the shared
    folder once per application and add it with ``addPyFile``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out_dir = shared_dir(spark, "pyfiles")
    local_zip = os.path.join(tempfile.mkdtemp(prefix="tidemark-zip-"), "tidemark.zip")
    with zipfile.ZipFile(local_zip, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, root))
    fs, target = hadoop_path(spark, f"{out_dir}/tidemark.zip")
    fs.copyFromLocalFile(hadoop_path(spark, "file://" + local_zip)[1], target)
    sc.addPyFile(fs.makeQualified(target).toString())
    _SHIPPED.add(app)
