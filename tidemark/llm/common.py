"""Small helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, hadoop_path, pin_utc, remove_at_end

# The white space and word classes of the query contracts.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"

# A null id sorts before every other id.
NULL_ID = -(2 ** 63)

# Spark's setting that removes shuffle files at the end of an execution.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows per Arrow batch handed to Python: whole texts can be long.
ARROW_ROWS = 500


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def doc_key(col: str = "doc_id") -> Column:
    """The id as a never-null key (null counts as the smallest id)."""
    return F.coalesce(F.col(col).cast("bigint"), F.lit(NULL_ID))


def from_key(col: str = "key") -> Column:
    """Back from :func:`doc_key` to the id."""
    return F.when(F.col(col) != NULL_ID, F.col(col))


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for a written table; it
    goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    remove_at_end(spark, path)
    return path


def saved(df: DataFrame, name: str, path: str | None = None, clean: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts
    the lineage, and what follows reads the same rows whatever executor is lost.
    A table that is read only for a while has a ``path`` of :func:`scratch`, to be :func:`removed`.
    With ``clean`` the shuffle files of the write go when it ends: its plan is its own, nothing else reads them."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, str(clean or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def saved_dealt(df: DataFrame, name: str, col: str, pieces: int) -> DataFrame:
    """As :func:`saved` with ``clean``, dealt by ``col`` into ``pieces`` buckets: a join or a cogroup by ``col`` reads
    them as they are, without another shuffle. The catalog's entry goes at once; the files and the plan that reads them stay."""
    spark = df.sparkSession
    path, table = scratch(spark, name), f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.bucketBy(pieces, col).option("path", path).saveAsTable(table, format="parquet")
        out = spark.table(table)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return out


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing will read again, before the application ends."""
    for path in paths:
        fs, p = hadoop_path(spark, path)
        fs.delete(p, True)


def apart(col: str) -> Column:
    """A join key that tells as much as ``col`` (a long) but not the planner that
    it does. A side that was just aggregated by ``col`` is then shuffled for the
    join too, and adaptive execution can split a hot key of the other side, which
    it only does between two plain shuffles."""
    return F.col(col).bitwiseXOR(F.lit(-1).cast("bigint"))


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, since a row holds a whole text."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def held_out(modulus: int, remainder: int, col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def packed(texts: DataFrame) -> DataFrame:
    """(key, packed) of (key, text) rows: the texts compressed and dealt by key.

    Several joins on the key read this one shuffle: the key's null check is
    said here, else an inner join would add it to its own copy of the plan.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor
        pack = ZstdCompressor(level=3, write_checksum=False, write_content_size=True).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pack(t.as_py()) for t in b.column(1)], pa.binary())],
                                             ["key", "packed"])

    rows = texts.select("key", F.col("text").cast("binary")).mapInArrow(run, "key bigint, packed binary")
    return rows.filter(F.col("key").isNotNull()).repartition("key")


def unpacked(column: pa.Array) -> list[bytes]:
    """The texts of a ``packed`` column."""
    from zstandard import ZstdDecompressor
    unpack = ZstdDecompressor().decompress
    return [unpack(t.as_py()) for t in column]
