"""Exact dedup as a stateful streaming job.

Documents are keyed by the SHA-256 digest of their normalised text. A
Structured Streaming aggregation holds one entry a digest in a disk-backed
(RocksDB) state store, without watermark and so without expiry: the smallest
document id seen (the stable identifier) and the content locator -- the file
the row was read from and the length of its text. The entries are read back
with Spark's state reader. A document whose digest another one shares is a
*hit*: its full normalised bytes are compared with the located content, and
only equal bytes make a copy; the others are grouped again by their full text.

Everything is DataFrame code. Text moves through one shuffle; a digest that a
third of all rows share is pre-aggregated before the state and, where texts
meet, sits on the splittable side of a join against one located row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, doc_key, from_key, read_documents, saved, scratch, text_of
from tidemark.streaming.runner import state_partitions

FILES_PER_BATCH = 1000   # landed files that one micro-batch takes

# Fixed settings of the state store: bounded native memory, no space set aside in files.
STATE = {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
         "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def normalised(col: str = "text") -> Column:
    """White space runs become one space; null counts as empty."""
    return F.regexp_replace(text_of(col), SPACE, " ")


def run_state(landed: DataFrame, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream the records landed in ``path`` through the keyed state; returns
    the state's entries: digest, key (stable identifier), bytes, file, seen."""
    spark = landed.sparkSession
    stream = (spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", str(files_per_batch)).parquet(path))
    entry = F.min(F.struct("key", "bytes", "file")).alias("entry")
    ck, before = scratch(spark, "dedup-state"), {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        with state_partitions(spark):
            q = (stream.groupBy("digest").agg(entry, F.count("*").alias("seen"))
                 .writeStream.outputMode("update").format("noop").option("checkpointLocation", ck)
                 .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    state = spark.read.format("statestore").load(ck)
    value = [f.name for f in state.schema["value"].dataType.fields]
    first, seen = (F.col("value").getField(n) for n in value)
    return state.select(F.col("key").getField("digest").alias("digest"),
                        first["key"].alias("key"), first["bytes"].alias("bytes"),
                        first["file"].alias("file"), seen.alias("seen"))


def exact_dedup(docs: DataFrame, digest_bits: int = 256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One small row a document: key, text_sha256, keep_key, group_size, kept.

    Null text counts as empty; texts are equal when their normalised bytes are.
    Null ids count as the smallest id. Of rows that share the smallest id
    of their group one stays, and it is left open which. An empty table gives
    no rows. Columns beside doc_id and text are not read. ``digest_bits``
    shortens the digest, so that tests can make digests collide.
    """
    spark = docs.sparkSession
    landing = scratch(spark, "dedup-landing")
    sha = F.sha2(F.col("norm"), 256)
    records = (docs.select(doc_key().alias("key"), normalised().alias("norm"), F.input_file_name().alias("file"))
               .select("key", sha.alias("text_sha256"), F.substring(sha, 1, digest_bits // 4).alias("digest"),
                       F.octet_length("norm").cast("bigint").alias("bytes"), "file"))
    records.write.parquet(landing)
    landed = spark.read.schema(records.schema).parquet(landing)
    state = saved(run_state(landed, landing, files_per_batch), "dedup-entries")
    hits = _hits(docs, state, digest_bits)
    # A group is a digest, or else the full text of the rows whose bytes differed.
    # Written, so that the join below has a shuffle of its own on either side and a hot digest is split.
    groups = saved(hits.groupBy("digest", "other").agg(F.count("*").alias("group_size"), F.min("key").alias("keep_key")),
                   "dedup-groups")
    on = (F.col("h.digest") == F.col("g.digest")) & F.col("h.other").eqNullSafe(F.col("g.other"))
    shared = hits.alias("h").join(groups.alias("g"), on).select(
        "h.key", "h.text_sha256", "g.keep_key", "g.group_size")
    single = state.filter("seen = 1").select(F.col("digest").alias("d"))
    alone = landed.join(single, F.col("digest") == F.col("d")).select(
        "key", "text_sha256", F.col("key").alias("keep_key"), F.lit(1).cast("bigint").alias("group_size"))
    return _one_kept(alone.unionByName(shared))


def _hits(docs: DataFrame, state: DataFrame, digest_bits: int) -> DataFrame:
    """Every document whose digest is shared, held against the located content:
    key, digest, text_sha256 and ``other``: its full text if the bytes differ."""
    rows = docs.select(doc_key().alias("key"), normalised().alias("norm"))
    rows = rows.withColumn("digest", F.substring(F.sha2("norm", 256), 1, digest_bits // 4))
    entry = state.filter("seen > 1").select(F.col("digest").alias("d"), F.col("key").alias("at"), F.col("bytes").alias("n"))
    shared = saved(rows.join(entry, F.col("digest") == F.col("d")), "dedup-shared")
    located = (shared.filter((F.col("key") == F.col("at")) & (F.octet_length("norm") == F.col("n")))
               .groupBy("digest").agg(F.min("norm").alias("content")).withColumnRenamed("digest", "c"))
    # Reversed, the digest tells the planner nothing: both sides are shuffled and a hot one is split.
    checked = shared.join(located, F.reverse("digest") == F.reverse("c"))
    return saved(checked.select("key", "digest", F.sha2("norm", 256).alias("text_sha256"),
                                F.when(F.col("norm") != F.col("content"), F.col("norm")).alias("other")), "dedup-hits")


def _one_kept(rows: DataFrame) -> DataFrame:
    """``kept``: the row with the group's smallest id, one only where rows repeat."""
    first = rows.filter("key = keep_key")
    rest = rows.filter("key <> keep_key").withColumn("kept", F.lit(False))
    w = Window.partitionBy("text_sha256", "key").orderBy("key")
    first = first.withColumn("kept", F.row_number().over(w) == 1)
    return first.unionByName(rest)


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    kept = exact_dedup(docs, **options).filter("kept").select(F.col("key").alias("k"), F.col("text_sha256").alias("h"))
    rows = docs.select(F.struct("*").alias("row"), doc_key().alias("key"), F.sha2(normalised(), 256).alias("sha"))
    return (rows.join(kept, (F.col("key") == F.col("k")) & (F.col("sha") == F.col("h")))
            .dropDuplicates(["key", "sha"]).select("row.*"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return exact_dedup(docs).select(from_key("key").alias("doc_id"), from_key("keep_key").alias("keep_id"),
                                    "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
