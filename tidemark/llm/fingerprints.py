"""Document fingerprints by winnowing, in DataFrame functions only.

A text is a sequence of units: its words, words above ``LONGEST`` characters
cut into pieces, so that text without spaces has many units too. Every
``GRAM`` units in a row are hashed; in every window of ``WINDOW`` successive
hashes the smallest is chosen, of equal ones the rightmost; a text of no more
than one window keeps all its hashes. The chosen hashes with their positions
are the fingerprint. Two texts that share
``WINDOW + GRAM - 1`` units in a row choose a hash in common there.

A chosen hash is one long: 40 bits of the hash, then the position counted
down in 23 bits, so that the array minimum of a slice prefers the rightmost of
equal hashes and keeps its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import doc_key, from_key, read_documents, saved, text_of

GRAM = 4
WINDOW = 12
LONGEST = 24
POSITIONS = 23                      # bits of a position
LAST = (1 << POSITIONS) - 1


def with_units(rows: DataFrame, text: str, units: str = "units") -> DataFrame:
    pattern = rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}"
    return rows.withColumn(units, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))


def with_hashes(rows: DataFrame, units: str = "units", hashes: str = "hashes") -> DataFrame:
    """The packed hash of every gram; fewer units than a gram are hashed together."""
    u, n = F.col(units), F.size(units)

    def packed(h: Column, at: Column) -> Column:
        high = F.shiftleft(h.bitwiseAND(F.lit((1 << 40) - 1)), POSITIONS)
        return high.bitwiseOR(F.lit(LAST).cast("bigint") - at.bitwiseAND(F.lit(LAST)).cast("bigint"))

    grams = F.transform(F.sequence(F.lit(0), n - GRAM),
                        lambda i: packed(F.xxhash64(*[F.get(u, i + j) for j in range(GRAM)]), i))
    short = F.array(packed(F.xxhash64(u), F.lit(0)))
    return rows.withColumn(hashes, F.when(n >= GRAM, grams).when(n > 0, short)
                           .otherwise(F.expr("cast(array() as array<bigint>)")))


def chosen(hashes: str = "hashes") -> Column:
    """The hashes that winnowing chooses, in the order of their positions."""
    h, n = F.col(hashes), F.size(hashes)
    windows = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.array_min(F.slice(h, i, F.lit(WINDOW))))
    return F.when(n > WINDOW, F.array_distinct(windows)).otherwise(h)


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the fingerprint of column ``text``, an array of packed hashes."""
    step = with_hashes(with_units(rows, text, "__units"), "__units", "__hashes").drop("__units")
    return step.withColumn(out, chosen("__hashes")).drop("__hashes")


def shown(fingerprint: str) -> Column:
    """The fingerprint as text: ``hash:position`` in order, comma-joined."""
    return F.array_join(F.transform(fingerprint, lambda p: F.concat(
        F.lower(F.lpad(F.hex(F.shiftright(p, POSITIONS)), 10, "0")), F.lit(":"),
        (F.lit(LAST) - p.bitwiseAND(F.lit(LAST))).cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of the chosen hashes; two empty fingerprints are alike."""
    x = F.transform(a, lambda p: F.shiftright(p, POSITIONS))
    y = F.transform(b, lambda p: F.shiftright(p, POSITIONS))
    both = F.size(F.array_intersect(x, y))
    either = F.size(F.array_union(x, y))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def next_keys(keys: DataFrame) -> DataFrame:
    """(key, next) for distinct keys in rising order; after the last comes the first.

    Keys are range partitioned and written with the number of their part;
    inside a part a window leads to the next key, and from a part's end a table of
    one row a part leads to the next part's first key.
    """
    parts = (keys.select("key").distinct().repartitionByRange("key")
             .withColumn("part", F.spark_partition_id()))
    parts = saved(parts, "fingerprint-keys")
    ends = Window.orderBy("part")
    firsts = parts.groupBy("part").agg(F.min("key").alias("first"))
    firsts = firsts.select(F.col("part").alias("p"), F.coalesce(
        F.lead("first").over(ends), F.min("first").over(Window.partitionBy())).alias("after"))
    inside = F.lead("key").over(Window.partitionBy("part").orderBy("key"))
    # One row a part of the shuffle: small enough to broadcast whatever the input.
    return (parts.withColumn("inside", inside).join(F.broadcast(firsts), F.col("part") == F.col("p"))
            .select("key", F.coalesce("inside", "after").alias("next")))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """One row a document: key, n_chars, edited, fp, edited_fp, next_fp.

    Null text counts as empty and a null id as the smallest. The next document
    has the next larger id; where rows share that id it is the one with the
    smallest replaced part (then fingerprint). A lone id follows itself. Rows
    that share an id have the same next document and each get their row.
    An empty table gives no rows; columns beside doc_id and text are not read.
    """
    base = docs.select(doc_key().alias("key"), text_of().alias("text"))
    quarter = F.floor(F.length("text") / 4)
    needs = base.groupBy("key").agg(F.max(quarter).alias("need"))
    follow = saved(next_keys(base).join(needs.withColumnRenamed("key", "k"), F.col("key") == F.col("k"))
                   .select(F.col("key").alias("prev"), "next", "need"), "fingerprint-next")
    rows = with_fingerprint(base, "text", "fp").repartition("key")
    heads = (rows.join(follow, F.col("key") == F.col("next"))
             .select("prev", F.substring("text", F.lit(1), F.col("need").cast("int")).alias("head"), F.col("fp").alias("next_fp"))
             .groupBy("prev").agg(F.min(F.struct("head", "next_fp")).alias("n")).select("prev", "n.*"))
    met = rows.join(heads, F.col("key") == F.col("prev"))
    edited = F.concat(F.substring("text", F.lit(1), (F.length("text") - quarter).cast("int")),
                      F.substring("head", F.lit(1), quarter.cast("int")))
    met = met.select("key", F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    return with_fingerprint(met, "edited", "edited_fp")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    return fingerprinted(read_documents(spark, sf_dir)).select(
        from_key("key").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        shown("fp").alias("fingerprint"), shown("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
