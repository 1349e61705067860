"""Merkle manifest of a dataset by butterfly exchange.

Every document is a leaf. Per language the leaves, in order of doc_id, are the
bottom of a tree of fanout 8; the languages' roots are the leaves of one more such tree.

Leaves are dealt in blocks of ``8 ** LEVELS`` consecutive ones. A block hashes its own
subtree, and from then on all blocks climb together: in round ``r`` every block
already knows the root of its aligned group of ``8 ** r`` blocks, and the blocks of
eight neighbouring groups that stand at the same offset swap these roots. Each hashes
the common parent itself, so ancestors are hashed redundantly, the swapped roots are
the siblings of its proofs, and after the last round every block has the whole upper
proof: nothing has to be passed down. Where the last group is short, its blocks
answer for the offsets it lacks. A round is one shuffle of at most eight
digests a block, whatever the language's share of the rows.

Blocks meet their upper proof by (language, block), at most ``8 ** LEVELS`` rows each.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, read_documents, saved
from tidemark.operators.sequence import keyed_running

FANOUT_BITS = 3      # fanout 8
LEVELS = 4           # levels inside a block: 4,096 leaves

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a row's fields, each as ``bytes:value`` or ``-`` if null."""
    values = [F.col(c).cast("string") for c in FIELDS[:-1]] + [F.col("text") if text is None else text]
    told = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def _hashed(digests: Iterable[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _tree(leaves: list[str], levels: int | None) -> list[list[str]]:
    """The nodes level by level, for so many levels or until one remains."""
    out = [leaves]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([_hashed(below[i:i + 8]) for i in range(0, len(below), 8)])
    return out


def _siblings(tree: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    """(place in the run, the run's others) of leaf ``at`` on each level."""
    out = []
    for nodes in tree[:-1]:
        run = nodes[at & ~7:(at & ~7) + 8]
        out.append((at & 7, run[:at & 7] + run[(at & 7) + 1:]))
        at >>= FANOUT_BITS
    return out


def _folded(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    for place, others in path:
        leaf = _hashed(others[:place] + [leaf] + others[place:])
    return leaf


def _sorted_leaves(rows: pa.Table) -> tuple[pa.Table, list[str]]:
    rows = rows.sort_by("at")
    return rows, [x.hex() for x in rows["leaf"].to_pylist()]


def block_roots(placed: DataFrame, levels: int) -> DataFrame:
    """(grp, block, low, high): a block's root if it is its group's only one, and else."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        leaves = _sorted_leaves(rows)[1]
        return pa.table({"grp": [key[0].as_py()], "block": [key[1].as_py()],
                         "low": [_tree(leaves, None)[-1][0]], "high": [_tree(leaves, levels)[-1][0]]})

    return placed.groupBy("grp", "block").applyInArrow(run, "grp string, block bigint, low string, high string")


def exchanged(state: DataFrame, r: int) -> DataFrame:
    """Round ``r`` over (grp, block, n, digest, path): blocks of eight neighbouring
    groups of 8^r blocks swap their groups' roots and hash the parent."""
    bits, size = FANOUT_BITS * r, 1 << (FANOUT_BITS * r)
    groups = F.shiftright(F.col("n") + (size - 1), bits)

    def held(s: Column) -> Column:      # blocks of group s
        return F.least(F.lit(size).cast("bigint"), F.col("n") - s * size)

    mine = state.withColumn("s", F.shiftright("block", bits)).withColumn("o", F.col("block") - F.col("s") * size)
    first = F.shiftleft(F.shiftright("s", FANOUT_BITS), FANOUT_BITS)
    sent = mine.withColumn("x", F.explode(F.sequence(first, F.least(first + 7, groups - 1))))
    # A short group's blocks take turns in answering for the offsets it lacks.
    others = F.when(F.col("o") < held(F.col("x")), F.transform(
        F.sequence(F.col("o"), held(F.col("x")) - 1, held(F.col("s"))), lambda y: F.col("x") * size + y))
    own = F.col("x") == F.col("s")
    sent = sent.select("grp", "n", F.col("s").alias("whose"), "digest", F.when(own, F.col("path")).alias("path"),
                       F.explode(F.when(own, F.array("block")).otherwise(others)).alias("block"))
    met = sent.groupBy("grp", "block", "n").agg(F.sort_array(F.collect_list(F.struct("whose", "digest"))).alias("run"),
                                                F.first("path", ignorenulls=True).alias("path"))
    place = F.shiftright("block", bits)
    rest = F.transform(F.filter("run", lambda d: d["whose"] != place), lambda d: d["digest"])
    step = F.struct(place.bitwiseAND(F.lit(7).cast("bigint")), rest)
    step = step.cast("struct<place:bigint,others:array<string>>")
    more = groups > 1
    return met.select(
        "grp", "block", "n",
        F.when(more, F.sha2(F.array_join("run.digest", "").cast("binary"), 256)).otherwise(F.col("run.digest")[0]).alias("digest"),
        F.when(more, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"))


def climbed(placed: DataFrame, levels: int) -> DataFrame:
    """(grp, block, n, digest, path): of every block its group's root and the
    siblings above it, of (grp, block, at, leaf) rows; ``n`` counts the group's blocks."""
    roots = saved(block_roots(placed, levels), "merkle-blocks")
    counts = roots.groupBy(F.col("grp").alias("g")).agg((F.max("block") + 1).alias("n"))
    state = roots.join(counts, F.col("grp") == F.col("g")).select(
        "grp", "block", "n", F.when(F.col("n") == 1, F.col("low")).otherwise(F.col("high")).alias("digest"),
        F.array().cast("array<struct<place:bigint,others:array<string>>>").alias("path"))
    most = roots.agg(F.max("block")).first()[0] or 0
    rounds = -(-most.bit_length() // FANOUT_BITS)
    for r in range(rounds):
        state = exchanged(state, r)
    return saved(state, "merkle-climbed")


def _blocked(rows: DataFrame, order: list[str], levels: int) -> DataFrame:
    """``rows`` with their position ``at`` in the group and their ``block``."""
    return keyed_running(rows, ["grp"], order, seq_col="at").withColumn("at", F.col("at") - 1).withColumn(
        "block", F.shiftright("at", FANOUT_BITS * levels))


def _path_of(row: dict) -> list[tuple[int, list[str]]]:
    return [(p["place"], p["others"]) for p in row["path"]]


def _top(state: DataFrame, levels: int) -> DataFrame:
    """(grp, root, path) of every group: its root's place in the tree of all groups."""
    subroots = state.where("block = 0").select(F.col("grp").alias("member"), F.unhex("digest").alias("leaf"),
                                               F.lit("").alias("grp"))
    placed = _blocked(subroots, ["member"], levels)
    above = climbed(placed, levels)

    def run(rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows, leaves = _sorted_leaves(rows)
        up = upper.to_pylist()[0]
        tree = _tree(leaves, None if up["n"] == 1 else levels)
        paths = [_siblings(tree, i) + _path_of(up) for i in range(len(leaves))]
        return pa.table({"grp": rows["member"], "root": [up["digest"]] * len(leaves),
                         "path": [[{"place": p, "others": o} for p, o in path] for path in paths]}, schema=pa.schema(
            [("grp", pa.string()), ("root", pa.string()),
             ("path", pa.list_(pa.struct([("place", pa.int64()), ("others", pa.list_(pa.string()))])))]))

    return (placed.groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInArrow(
        run, "grp string, root string, path array<struct<place:bigint,others:array<string>>>"))


def manifest(docs: DataFrame, claimed: Column | None = None, levels: int = LEVELS, with_proof: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and, if asked for,
    ``proof`` (the siblings from leaf to root) of every row.

    ``claimed`` is the text somebody shows for a row; null where nobody does: the
    row's own text is folded then. ``folded_root`` is computed from its leaf and the
    proof. A claimed null text must be told by the caller as the row's own.

    A null field has its own mark, so null and empty differ. A null lang is a
    language, the first one; a null id is the first of its language. Rows of one id
    follow each other by their digests, equal rows each have their own place. A
    single document has an empty proof. An empty table gives no rows. Other columns
    are not read.
    """
    shown = F.lit(None).cast("string") if claimed is None else claimed
    digests = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("grp"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(leaf_digest()).alias("leaf"), F.when(shown.isNotNull(), F.unhex(leaf_digest(shown))).alias("told"))
    # Positions sample their input; the digests are written first so that texts are read once.
    placed = _blocked(saved(digests, "merkle-leaves"), ["doc_id", "leaf", "told"], levels)
    state = climbed(placed, levels)
    top = _top(state, levels).select(F.col("grp").alias("g"), "root", F.col("path").alias("last"))
    above = state.join(top, F.col("grp") == F.col("g")).select(
        "grp", "block", "n", "digest", "root", F.concat("path", "last").alias("path"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + ["proof"] * with_proof

    def run(rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows, leaves = _sorted_leaves(rows)
        up = upper.to_pylist()[0]
        tree = _tree(leaves, None if up["n"] == 1 else levels)
        path = _path_of(up)
        tail = "".join(x for _, others in path for x in others)
        told = rows["told"].to_pylist()
        proofs, folded, listed = [], [], []
        for i, leaf in enumerate(leaves):
            own = _siblings(tree, i)
            proofs.append(sha256(("".join(x for _, others in own for x in others) + tail).encode()).hexdigest())
            folded.append(_folded(told[i].hex() if told[i] is not None else leaf, own + path))
            if with_proof:
                listed.append([x for _, others in own + path for x in others])
        cols = [rows["doc_id"], pa.array(leaves), pa.array([up["digest"]] * len(leaves)), pa.array([up["root"]] * len(leaves)),
                pa.array(proofs), pa.array(folded), pa.array([f == up["root"] for f in folded])]
        if with_proof:
            cols.append(pa.array(listed, pa.list_(pa.string())))
        return pa.table(cols, names=names)

    schema = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + (", proof array<string>" if with_proof else ""))
    return placed.groupBy("grp", "block").cogroup(above.groupBy("grp", "block")).applyInArrow(run, schema)


def tampered() -> Column:
    """The text with its A-Z lower-cased where 3 divides the id's crc32, else null: nobody touched it."""
    return F.when(held_out(3, 0), F.translate("text", UPPER, UPPER.lower()))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    return manifest(read_documents(spark, sf_dir), tampered())
