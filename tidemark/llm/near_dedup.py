"""SimHash near-dedup with Golay-code fuzzy hashing.

A 64-bit fingerprint is the bitwise majority of the XXH64 hashes of a
document's word shingles. Two fingerprints are linked when at most two bits
differ. The 64 bits are cut into segments of 23, 23 and 18 bits: with two
errors over three segments at least one segment is free of errors, and the
segment after it has at most two. A segment is decoded with the perfect binary
Golay code [23, 12, 7] to the indices (12 bits) of all codewords within
distance four: one or six of them. Words at distance two or less have a point
within one of both, whose codeword is in both lists, so they share an index.
A key is an error-free segment together with one index of the next segment:
3 to 18 keys a distinct fingerprint, 30 to 35 bits each. Buckets join on the key
and every pair is verified by its bit distance. In a bucket above ``PAIRS``
members no pairs are made: members meet in the points within one bit of them,
where two fingerprints meet exactly if they differ in at most two bits, and a
point has at most 65 of them.

Copies collapse to one fingerprint before any key is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import apart, doc_key, from_key, read_documents, saved, small_batches

SHINGLE = 3
MAX_BITS = 2
PAIRS = 8              # members of a bucket up to which pairs are compared
HASHES = 1 << 15       # hashes whose bits are counted at once

# Generator polynomial of the Golay code (degree 11), code length,
# hash seed, and the segments as (lowest bit, bits).
GOLAY = 0b110001110101
LENGTH = 23
SEED = 42
SEGMENTS = ((41, 23), (18, 23), (0, 18))


def _fingerprint(text: bytes, shingle: int) -> bytes:
    """The fingerprint as eight bytes, highest first."""
    from xxhash import xxh64_digest
    words = text.lower().split()     # of bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return bytes(8)
    line = b" ".join(words)
    if n < shingle:
        return xxh64_digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = (ends - np.diff(ends, prepend=0)).tolist()
    ends = (ends - 1).tolist()
    set_bits, total = np.zeros(64, np.int64), n - shingle + 1
    for at in range(0, total, HASHES):
        to = min(total, at + HASHES)
        digests = b"".join([xxh64_digest(line[s:e], SEED)
                            for s, e in zip(starts[at:to], ends[at + shingle - 1:to + shingle - 1])])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(set_bits * 2 > total).tobytes()


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key, text_hash, fp): the fingerprint of every row as a signed long.

    Null text counts as empty; no words give fingerprint zero, fewer words than
    a shingle the hash of the whole sequence.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b"".join([_fingerprint(t.as_py() or b"", shingle) for t in b.column(2)])
            fp = pa.array(np.frombuffer(fps, ">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], ["key", "text_hash", "fp"])

    rows = docs.select(doc_key().alias("key"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "key bigint, text_hash bigint, fp bigint")


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """``remainder`` of the 12 high bits, and for each syndrome the errors of
    up to four bits (six columns; -1 where there is only one)."""
    powers = []
    for i in range(LENGTH):
        r = 1 << i
        for bit in range(LENGTH - 1, 10, -1):
            if r >> bit & 1:
                r ^= GOLAY << (bit - 11)
        powers.append(r)
    high = np.arange(1 << 12)
    remainder = np.zeros(1 << 12, np.int64)
    for i in range(12):
        remainder ^= np.where(high >> i & 1, powers[11 + i], 0)
    lists: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for where in combinations(range(LENGTH), weight):
            syndrome = 0
            for i in where:
                syndrome ^= powers[i]
            lists[syndrome].append(sum(1 << i for i in where))
    errors = np.full((1 << 11, 6), -1, np.int64)
    for s, found in enumerate(lists):
        errors[s, :len(found)] = found
    return remainder, errors


def codeword_indices(words: np.ndarray, remainder: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Indices of the codewords within distance four of each 23-bit word; -1 fills up."""
    found = errors[(words & 0x7FF) ^ remainder[words >> 11]]
    return np.where(found < 0, -1, (words[:, None] ^ found) >> 11)


def golay_keys(fps: np.ndarray, remainder: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) of every key."""
    u = fps.astype(np.int64).view(np.uint64)
    segments = [((u >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
    at, keys = [], []
    for i, exact in enumerate(segments):
        index = codeword_indices(segments[(i + 1) % 3], remainder, errors)
        row, col = np.nonzero(index >= 0)
        at.append(row)
        keys.append((i << 40) | (exact[row] << 12) | index[row, col])
    return np.concatenate(at), np.concatenate(keys)


def links(fps: DataFrame) -> DataFrame:
    """(a, b), a < b: links that join all distinct ``fp`` at two bits or less
    into the right components (every link of small buckets, a star a point in large ones)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = golay_tables()
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            at, key = golay_keys(fp, *tables)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at])], ["bucket", "fp"])

    keyed = fps.select("fp").mapInArrow(run, "bucket bigint, fp bigint")
    counts = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("bucket", "b")
    shared = keyed.join(counts, F.col("bucket") == F.col("b")).select("bucket", "fp", "n")
    shared = saved(shared, "simhash-shared")
    pair = F.filter(F.transform("rest", lambda y: F.struct(F.least("fp", y).alias("a"), F.greatest("fp", y).alias("b"))),
                    lambda p: (p["a"] < p["b"]) & (F.bit_count(p["a"].bitwiseXOR(p["b"])) <= MAX_BITS))
    close = (shared.filter(F.col("n") <= PAIRS).groupBy("bucket").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
             .select(F.posexplode("fps").alias("i", "fp"), "fps")
             .select("fp", F.slice("fps", F.col("i") + 2, F.size("fps")).alias("rest"))
             .select(F.explode(pair).alias("p")).select("p.*").distinct())
    point = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))
    met = (shared.filter(F.col("n") > PAIRS).select("fp").distinct().select("fp", F.explode(point).alias("point"))
           .groupBy("point").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
           .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
           .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)).distinct())
    return close.unionByName(met).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link.

    Alternates large-star and small-star steps; each step takes a minimum per
    node (pre-aggregated) and joins it back, never a node's neighbours in one
    place. Every round is written to the shared folder.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = saved(edges.select("a", "b"), "links-0")
    seen, turn = mark(now), 0
    while seen[0]:
        turn += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, F.col("a") == F.col("u")).filter("b > a")
                 .select(F.col("m").alias("a"), "b").filter("a < b").distinct())
        least = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.join(least, F.col("b") == F.col("u"))
        small = (small.select(F.col("m").alias("x"), F.col("a").alias("y"))
                 .unionByName(least.select(F.col("m").alias("x"), F.col("u").alias("y")))
                 .filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        now = saved(small, f"links-{turn}")
        before, seen = seen, mark(now)
        if seen == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """key, text_hash, fp and component (smallest key reachable) of every row.

    A null id counts as the smallest id; rows with one fingerprint are linked,
    empty texts too; repeated rows each get their row. An empty table gives no
    rows. Columns beside doc_id and text are not read. The pigeonhole
    argument is laid out for two bits; another number is refused.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"the segments and keys are laid out for {MAX_BITS} bits")
    rows = saved(simhash(docs, shingle), "simhash-rows")
    fps = saved(rows.groupBy("fp").agg(F.min("key").alias("first_key")), "simhash-fps")
    of = components(links(fps))
    named = of.join(fps, F.col("node") == F.col("fp"))
    roots = named.groupBy(F.col("root").alias("r")).agg(F.min("first_key").alias("component"))
    linked = named.join(roots, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component")
    alone = fps.join(linked, F.col("fp") == F.col("f"), "left").select(
        F.col("fp").alias("f"), F.coalesce("component", "first_key").alias("component"))
    return rows.join(alone, apart("fp") == apart("f")).select("key", "text_hash", "fp", "component")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group (its smallest id), with its columns."""
    groups = near_duplicates(docs, shingle, max_bits)
    first = groups.groupBy("component").agg(F.min(F.struct("key", "text_hash")).alias("first")).select(
        F.col("first.key").alias("k"), F.col("first.text_hash").alias("h"))
    rows = docs.select(F.struct("*").alias("row"), doc_key().alias("key"), F.xxhash64("text").alias("text_hash"))
    return (rows.join(first, (F.col("key") == F.col("k")) & (F.col("text_hash") == F.col("h")))
            .dropDuplicates(["key", "text_hash"]).select("row.*"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = near_duplicates(read_documents(spark, sf_dir))
    return found.select(from_key("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        from_key("component").alias("component_id"))
