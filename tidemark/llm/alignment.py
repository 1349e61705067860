"""Alignment of two tokenizers' tokens, as Arrow tables.

A task encodes some documents with both tokenizers and flattens the two lists of
ids; every token knows its document by the parent indices. Segmented cumulative sums of
the tokens' byte lengths give where each token ends in its document. Tables of both sides are
joined (Acero's hash join, full outer) on a key made of document and end: an end that both
have closes a group, and between two neighbouring ends lies the overlap of exactly one
token of each side, a link. ``group_by`` counts the links of each pair of ids.

Documents are taken together in segments of about ``SEGMENT`` bytes. A segment is one
written row: its documents' results, its pairs with their partial counts, and its
documents' links as numbers of its pairs. Spark merges the partial counts, finds the highest
of each B id, and joins both back to the pairs of the segments, so that what is
shuffled are a segment's distinct pairs, not its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import codec
from tidemark.llm.common import apart, doc_key, from_key, read_documents, saved, small_batches, text_of

SEGMENT = 8 << 20        # bytes of text whose pairs are counted together
PART = 1 << 20           # bytes of text joined at once
DOC_BITS = 40            # of a key: a document's bytes

SEGMENT_SCHEMA = ("segment bigint, docs array<struct<key:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,"
                  "groups_sha256:string,groups:string>>, pairs array<struct<a:int,b:int,n:bigint>>, links binary")


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Side:
    """A tokenizer: ids of texts, and the bytes of its tokens."""

    def __init__(self, token_bytes: list[bytes], encode):
        self.encode = encode
        self.bytes = pa.array(token_bytes, pa.large_binary())
        self.lengths = pa.array([len(b) for b in token_bytes], pa.int64())


def byte_level(definition: str) -> Side:
    """A: byte-level BPE over a space and the text; special tokens' strings are plain text."""
    c = codec(definition)
    exact = c.exact.from_str(definition)
    exact.no_truncation()
    exact.no_padding()
    exact.encode_special_tokens = True

    def encode(texts: list[str]) -> list[list[int]]:
        told = [" " + t for t in texts]
        if c.fast is None:
            return [e.ids for e in exact.encode_batch(told, add_special_tokens=False)]
        return [exact.encode(t, add_special_tokens=False).ids if c.OTHER.search(t) else c.fast.encode_ordinary(t) for t in told]

    return Side(c.bytes_of.tolist(), encode)


def pieces(model: bytes) -> Side:
    """B: sentencepiece, which puts the space before the text itself."""
    from sentencepiece import SentencePieceProcessor
    p = SentencePieceProcessor(model_proto=model)
    names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
    told = [bytes([int(x[3:-1], 16)]) if p.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    return Side(told, lambda texts: p.encode(texts, num_threads=1))


@cache
def sides(definition: str, model: bytes) -> tuple[Side, Side, pa.Array]:
    """Both tokenizers, and the ids as text with what follows them in a group's description."""
    a, b = byte_level(definition), pieces(model)
    told = [f"{i}{end}".encode() for n, ends in ((len(a.bytes), ",|"), (len(b.bytes), ",;")) for end in ends for i in range(n)]
    return a, b, pa.array(told, pa.large_binary())


def _lists(ids: list[list[int]]) -> pa.LargeListArray:
    offsets = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return pa.LargeListArray.from_arrays(offsets, pa.array(np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])))


def _slices(values: pa.Array, offsets: np.ndarray) -> list[memoryview]:
    """The joined bytes of the values between neighbouring ``offsets``."""
    _, places, data = values.buffers()
    at = np.frombuffer(places, np.int64)[offsets].tolist()
    data = memoryview(data or b"").cast("B")        # bytes, not signed numbers
    return [data[x:y] for x, y in zip(at, at[1:])]


def _spelt(side: Side, ids: list[list[int]], want: list[bytes]) -> list[bool]:
    """Whether each text's tokens spell it."""
    rows = _lists(ids)
    return [x == y for x, y in zip(_slices(pc.take(side.bytes, pc.list_flatten(rows)), rows.offsets.to_numpy()), want)]


def _ends(rows: pa.LargeListArray, lengths: pa.Array, name: str) -> pa.Table:
    """(key, number) of every token; the key is its document and its end there."""
    doc = pc.list_parent_indices(rows)
    total = pc.cumulative_sum(pc.take(lengths, pc.list_flatten(rows)))
    before = pa.array(np.append(0, total.to_numpy())[rows.offsets.to_numpy()[:-1]])
    end = pc.subtract(total, pc.take(before, doc))
    return pa.table({"key": pc.add(pc.shift_left(doc, DOC_BITS), end), name: pa.array(np.arange(len(total)))})


class Aligned:
    """Links and groups of some texts, encoded by both sides."""

    def __init__(self, texts: list[str], a: Side, b: Side, told: pa.Array):
        want = [b" " + t.encode() for t in texts]
        ids = [side.encode(texts) for side in (a, b)]
        good = [bool(t) and x and y for t, x, y in zip(texts, _spelt(a, ids[0], want), _spelt(b, ids[1], want))]
        rows = [_lists([x if g else [] for x, g in zip(some, good)]) for some in ids]
        flat = [pc.list_flatten(r) for r in rows]
        self.n_a, self.n_b = (np.diff(r.offsets.to_numpy()) for r in rows)
        ends = _ends(rows[0], a.lengths, "a").join(_ends(rows[1], b.lengths, "b"), "key", join_type="full outer", use_threads=False)
        ends = ends.sort_by("key").combine_chunks()
        both = pc.and_(ends["a"].is_valid(), ends["b"].is_valid())
        common = both.to_numpy().astype(np.int64)
        self.doc = pc.shift_right(ends["key"], DOC_BITS).to_numpy()
        per_doc = pa.table({"doc": self.doc, "common": common}).group_by("doc", use_threads=False).aggregate(
            [("common", "sum"), ("common", "count")])
        self.n_groups, self.n_links = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        at = per_doc["doc"].to_numpy()
        self.n_groups[at], self.n_links[at] = per_doc["common_sum"].to_numpy(), per_doc["common_count"].to_numpy()
        # The token that an end lies in is the next one that ends; documents end together.
        ida, idb = (pc.take(ids, pc.fill_null_backward(ends[x])).cast(pa.int64()) for x, ids in zip("ab", flat))
        self.pair = pc.bit_wise_or(pc.shift_left(ida, 32), idb).combine_chunks()
        group = np.cumsum(common) - common
        of_a, of_b = (group[ends[x].is_valid().to_numpy()] for x in "ab")
        self.groups = self._described(of_a, of_b, *(x.to_numpy() for x in flat), len(a.bytes), len(b.bytes), told,
                                      rows[0].offsets.to_numpy() + rows[1].offsets.to_numpy())

    @staticmethod
    def _described(of_a, of_b, ida, idb, n_a, n_b, told, offsets) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text, from the tokens' groups."""
        last_a, last_b = (np.append(x[1:] != x[:-1], True)[:len(x)] for x in (of_a, of_b))
        out = np.empty(len(of_a) + len(of_b), np.int64)
        out[np.arange(len(of_a)) + np.searchsorted(of_b, of_a)] = ida + n_a * last_a
        out[np.arange(len(of_b)) + np.searchsorted(of_a, of_b, side="right")] = 2 * n_a + idb + n_b * last_b
        return [bytes(x[:-1]) for x in _slices(pc.take(told, pa.array(out)), offsets)]


def _counted(tables: list[pa.Table]) -> pa.Table:
    """(pair, n) merged, in the pairs' order."""
    merged = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")])
    return merged.rename_columns(["pair", "n"]).sort_by("pair").combine_chunks()


def _steps(numbers: np.ndarray, lengths: np.ndarray) -> bytes:
    """Sorted numbers of each text as compressed steps."""
    from zstandard import ZstdCompressor
    steps = np.diff(numbers, prepend=0)
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[first] = numbers[first]
    wide = len(steps) and steps.max() >= 1 << 16
    return (b"\x04" if wide else b"\x02") + ZstdCompressor(level=1).compress(steps.astype("<u4" if wide else "<u2").tobytes())


def _numbers(data: bytes, lengths: np.ndarray) -> np.ndarray:
    from zstandard import ZstdDecompressor
    total = np.cumsum(np.frombuffer(ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}"), dtype=np.int64)
    before = np.append(0, total)[np.cumsum(lengths) - lengths]
    return total - np.repeat(before, lengths)


def segments(docs: DataFrame, definition: str, model: bytes, with_groups: bool = False) -> DataFrame:
    """One row a segment: its documents, its pairs and its links."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        from pyspark import TaskContext
        a, b, told = sides(definition, model)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []      # (documents, their number of links, pairs of the links) of the parts of a segment
        counts: list[pa.Table] = []

        def part(keys: list[int], texts: list[str]) -> None:
            x = Aligned(texts, a, b, told)
            rows = [(k, int(na), int(nb), int(g), int(n), sha256(t).hexdigest() if na else "", t.decode() if with_groups else None)
                    for k, na, nb, g, n, t in zip(keys, x.n_a, x.n_b, x.n_groups, x.n_links, x.groups)]
            held.append((rows, x.n_links, x.pair.to_numpy()))
            counts.append(pa.table({"pair": x.pair}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
                          .rename_columns(["pair", "n"]))

        def segment() -> pa.RecordBatch:
            nonlocal number
            pairs = _counted(counts)
            every = pairs["pair"].to_numpy()
            lengths = np.concatenate([h[1] for h in held])
            places = np.searchsorted(every, np.concatenate([h[2] for h in held]))
            row = np.repeat(np.arange(len(lengths)) << 32, lengths)
            places = np.sort(row | places) & 0xFFFFFFFF
            names = ("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
            found = [dict(zip(names, r)) for h in held for r in h[0]]
            ab = [{"a": p >> 32, "b": p & 0xFFFFFFFF, "n": n} for p, n in zip(every.tolist(), pairs["n"].to_pylist())]
            out = pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()),
                pa.array([found], pa.list_(pa.struct([(n, pa.string() if n.startswith("groups") else pa.int64()) for n in names]))),
                pa.array([ab], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))),
                pa.array([_steps(places, lengths)], pa.binary())], ["segment", "docs", "pairs", "links"])
            number += 1
            held.clear()
            counts.clear()
            return out

        keys, texts, size, total = [], [], 0, 0
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(k)
                texts.append(t)
                size += len(t) + 1
                if size >= PART:
                    part(keys, texts)
                    total += size
                    keys, texts, size = [], [], 0
                if total >= SEGMENT:
                    yield segment()
                    total = 0
        if texts:
            part(keys, texts)
        if held:
            yield segment()

    return docs.select(doc_key().alias("key"), text_of().alias("text")).mapInArrow(run, SEGMENT_SCHEMA)


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, count, best) of every pair: its links in all documents, and whether no
    pair of the same B id has more. An id of B meets at most all ids of A."""
    pairs = found.select(F.explode("pairs").alias("p")).select("p.*")
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return totals.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, with_groups: bool = False) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked
    for, ``groups`` (the description itself) of every row.

    A text that is null or empty, or that one side's tokens do not spell (its
    normalisation changed it), has no tokens: zeros and ''. A null id counts as the
    smallest; repeated rows each count their links. An empty table gives no rows. Columns
    beside doc_id and text are not read. ``a_path`` and ``b_path`` name the vocabulary
    files; they are read on the driver and go out with the tasks.
    """
    ways = default_paths()
    with open(a_path or ways[0], encoding="utf-8") as f:
        definition = f.read()
    with open(b_path or ways[1], "rb") as f:
        model = f.read()
    found = saved(segments(docs, definition, model, with_groups), "alignment-segments")
    own = found.select("segment", F.posexplode("pairs").alias("place", "p")).select(
        "segment", "place", (F.shiftleft(F.col("p.a").cast("bigint"), 32) + F.col("p.b")).alias("pair"))
    totals = pair_counts(found).select((F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")).alias("total_of"), "count", "best")
    answers = own.join(totals, apart("pair") == apart("total_of")).select(
        F.col("segment").alias("of"), "place", "count", "best")
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ["groups"] * with_groups

    def run(rows: pa.Table, counts: pa.Table) -> pa.Table:
        place = counts["place"].to_numpy()
        best, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        best[place], count[place] = counts["best"].to_numpy().astype(np.int64), counts["count"].to_numpy()
        docs = rows["docs"].combine_chunks().flatten()
        each = {n: docs.field(n) for n in ("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")}
        lengths = each["n_links"].to_numpy()
        links = _numbers(rows["links"][0].as_py(), lengths)
        edges = np.append(0, np.cumsum(lengths))
        for name, value in (("n_best", best), ("count_sum", count)):
            each[name] = pa.array(np.diff(np.append(0, np.cumsum(value[links]))[edges]))
        return pa.table([each[n] for n in names], names=names)

    schema = ", ".join(f"{n} {'string' if n.startswith('groups') else 'bigint'}" for n in names)
    return (found.select("segment", "docs", "links").groupBy("segment")
            .cogroup(answers.groupBy("of")).applyInArrow(run, schema))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return aligned(read_documents(spark, sf_dir)).select(
        from_key("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
