"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of the last ``ROLL`` bytes has its low bits
zero, so equal passages get equal chunks wherever they stand. A chunk that
occurs in several places is encoded once, by the document that holds its first
occurrence, and its ids are joined to all documents that have it.

A chunk's ids hold in another document except near its ends, where a token may
reach across the join. The joins are repaired: the re-encoded span grows from
the join to the nearest place on either side where the chunk's own encoding and
that of the whole text must agree on a token's end. Such a place is between a
printable ASCII character and a space: the pre-tokenizer's pattern always splits
there and looks neither back nor ahead across it. Texts without one inside a
chunk are encoded whole.

Texts travel compressed through one shuffle, shared by both joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import apart, doc_key, from_key, packed, read_documents, small_batches, text_of, unpacked
from tidemark.llm.words import _numbers, joined, runs

ROLL = 32            # bytes in the rolling hash
CHUNK_BITS = 10      # a chunk has 2^10 bytes on average
LEAST = 64           # bytes of a chunk between its outer safe places, else it is not shared


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Encodes and decodes as the tokenizers library does with one vocabulary file.

    Text of plain characters goes through tiktoken with the same merges,
    several times faster; any other text and any text with a special token goes
    through the tokenizers library itself.
    """

    # The pattern of byte-level pre-tokenization, and characters on which both libraries agree.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    OTHER = re.compile("[^\t\n\r\x20-\x7eÀ-ſ]")

    def __init__(self, definition: str):
        import json

        self.definition = definition
        spec = json.loads(definition)
        pre = spec.get("pre_tokenizer") or {}
        vocab = {t: i for t, i in spec["model"]["vocab"].items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.specials = list(added)
        letters = self._letters()
        plain = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in added}
        self.bytes_of = np.empty(max([*vocab.values(), *added.values()]) + 1, object)
        self.bytes_of[:] = b""
        for b, i in plain.items():
            self.bytes_of[i] = b
        for t, i in added.items():
            self.bytes_of[i] = t.encode()
        self.fast = None
        # What the split places rely on; with another pre-tokenizer nothing is shared.
        self.splits = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                       and not spec.get("normalizer")
                       and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in spec["added_tokens"]))
        if self.splits and not spec["model"].get("dropout") and not spec["model"].get("ignore_merges"):
            import tiktoken
            self.fast = tiktoken.Encoding("plain", pat_str=self.PATTERN, mergeable_ranks=plain, special_tokens={})

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(self.definition)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @staticmethod
    def _letters() -> dict[str, int]:
        """The printable stand-in of every byte: itself where printable, else the next free from U+0100 on."""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in own]
        return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(other)}

    def encode(self, text: str) -> list[int]:
        if self.fast is None or self.OTHER.search(text) or any(s in text for s in self.specials):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(self.bytes_of[ids].tolist())
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode(errors="replace").encode()


@cache
def codec(definition: str) -> Codec:
    return Codec(definition)


class Chunks:
    """Chunks of some texts that may be shared: text number, two hashes, and
    the outer safe places (byte positions in the text)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.of = self.low = self.high = np.empty(0, np.int64)
        self.h1 = self.h2 = np.empty(0, np.uint64)
        if not n:
            return
        cut = np.zeros(n + 1, bool)
        if n > ROLL:
            rolling = runs(_numbers()[data], np.arange(n - ROLL + 1), ROLL)
            cut[ROLL:] = (rolling & np.uint64((1 << CHUNK_BITS) - 1)) == 0
            cut[:-1] &= (data & 0xC0) != 0x80
        starts, ends = offsets[:-1], offsets[1:] - 1     # a space stands between texts
        cut[starts], cut[ends] = True, True
        edges = np.flatnonzero(cut)
        low, high = edges[:-1], edges[1:]
        of = np.searchsorted(offsets, low, side="right") - 1
        inside = (high <= ends[of]) & (high - low >= LEAST)
        low, high, of = low[inside], high[inside], of[inside]
        safe = np.zeros(n, bool)
        safe[1:] = (data[1:] == 0x20) & (data[:-1] > 0x20) & (data[:-1] < 0x7F)
        places = np.flatnonzero(safe)
        if not len(places) or not len(low):
            return
        # The first place after the chunk's start and the last before its end.
        first = np.searchsorted(places, low, side="right")
        last = np.searchsorted(places, high, side="left") - 1
        good = (first < last) & (last >= 0)
        good[good] = places[last[good]] - places[first[good]] >= LEAST
        low, high, of, first, last = low[good], high[good], of[good], first[good], last[good]
        numbers = _numbers()[data]
        self.h1, self.h2 = runs(numbers, low, high - low, 1), runs(numbers, low, high - low, 2)
        self.of, self.low, self.high = of, places[first] - offsets[of], places[last] - offsets[of]


def chunks(texts: DataFrame) -> DataFrame:
    """(h1, h2, key, low, high) of the chunks of (key, text) rows, each once a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in joined([t.as_py() for t in b.column(1)]):
                c = Chunks(data, offsets)
                place = np.lexsort((c.low, c.h2, c.h1, c.of))
                of, h1, h2 = c.of[place], c.h1[place], c.h2[place]
                new = np.ones(len(place), bool)
                new[1:] = (of[1:] != of[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                at = place[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.h1[at].view(np.int64)), pa.array((c.h2[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                     pa.array(keys[first + c.of[at]]), pa.array(c.low[at]), pa.array(c.high[at])],
                    ["h1", "h2", "key", "low", "high"])

    return texts.select("key", F.col("text").cast("binary")).mapInArrow(
        run, "h1 bigint, h2 int, key bigint, low bigint, high bigint")


def _ids_type(c: Codec) -> str:
    return "<u2" if len(c.bytes_of) <= 1 << 16 else "<u4"


def _places(text: bytes) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Where the chunks of one text are, by their hashes."""
    k = Chunks(np.frombuffer(text, np.uint8), np.array([0, len(text) + 1]))
    h2 = (k.h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for h, place in zip(zip(k.h1.view(np.int64).tolist(), h2.tolist()), zip(k.low.tolist(), k.high.tolist())):
        out.setdefault(h, []).append(place)
    return out


def _encode_owned(rows: DataFrame, definition: str) -> DataFrame:
    """(h1, h2, ids) of the chunks that (key, packed, owned) rows encode for all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(definition)
        kind = _ids_type(c)
        for b in batches:
            h1, h2, ids = [], [], []
            for text, owned in zip(unpacked(b.column(1)), b.column(2)):
                mine = _places(text)
                for h in {(o["h1"], o["h2"]) for o in owned.as_py()} & mine.keys():
                    low, high = mine[h][0]
                    h1.append(h[0])
                    h2.append(h[1])
                    ids.append(np.array(c.encode(text[low:high].decode()), kind).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int32()), pa.array(ids, pa.binary())],
                                             ["h1", "h2", "ids"])

    return rows.select("key", "packed", "owned").mapInArrow(run, "h1 bigint, h2 int, ids binary")


def assembled(c: Codec, text: bytes, spans: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
    """Ids of a whole text from those of its shared chunks (low, high, ids), in
    order; what lies between them, across the joins, is encoded here."""
    parts, at = [], 0
    for low, high, ids in spans:
        if low < at:
            continue
        if low > at:
            parts.append(np.array(c.encode(text[at:low].decode()), np.uint32))
        parts.append(ids.astype(np.uint32))
        at = high
    if at < len(text):
        parts.append(np.array(c.encode(text[at:].decode()), np.uint32))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def encoded(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 and, unless told otherwise, ``ids`` of every row.

    Null text counts as empty and has no tokens; a null id counts as the
    smallest. Repeated rows each get their row, whichever text they have: a
    chunk's ids are found by its hashes, not by its place. An empty table gives
    no rows. Columns beside doc_id and text are not read. ``path`` names the
    vocabulary file; it is read on the driver and goes out with the tasks.
    """
    small_batches(docs.sparkSession)
    with open(path or default_path(), encoding="utf-8") as f:
        definition = f.read()
    texts = docs.select(doc_key().alias("key"), text_of().alias("text"))
    dealt = packed(texts)
    met = dealt
    if codec(definition).splits:
        found = chunks(texts)
        shared = (found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("key", "low", "high")).alias("o"))
                  .filter("n > 1"))
        owned = shared.groupBy(F.col("o.key").alias("k")).agg(F.collect_list(F.struct("h1", "h2", "o.low", "o.high")).alias("owned"))
        once = (_encode_owned(dealt.join(owned, F.col("key") == F.col("k")), definition).dropDuplicates(["h1", "h2"])
                .select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "ids"))
        reused = (found.join(once, (apart("h1") == apart("c1")) & (F.col("h2") == F.col("c2")))
                  .groupBy(F.col("key").alias("k")).agg(F.collect_list(F.struct("h1", "h2", "ids")).alias("reused")))
        met = dealt.join(reused, F.col("key") == F.col("k"), "left").select("key", "packed", "reused")
    else:
        met = dealt.withColumn("reused", F.expr("cast(null as array<struct<h1:bigint,h2:int,ids:binary>>)"))
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids"] if with_ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        c = codec(definition)
        kind = _ids_type(c)
        for b in batches:
            out = []
            for text, reused in zip(unpacked(b.column(1)), b.column(2)):
                spans, known = [], reused.as_py()
                if known:
                    by_hash = {(r["h1"], r["h2"]): np.frombuffer(r["ids"], kind) for r in known}
                    spans = sorted(((low, high, by_hash[h]) for h, places in _places(text).items() if h in by_hash
                                    for low, high in places), key=lambda x: x[0])
                ids = assembled(c, text, spans)
                row = [len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(), sha256(c.decode(ids)).hexdigest()]
                out.append(row + [ids.astype(np.int32)] if with_ids else row)
            cols = [b.column(0), pa.array([r[0] for r in out], pa.int64()), *[
                pa.array([r[i] for r in out], pa.string()) for i in (1, 2)]]
            if with_ids:
                cols.append(pa.array([r[3] for r in out], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "key bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return met.select("key", "packed", "reused").mapInArrow(run, schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded(read_documents(spark, sf_dir), with_ids=False).select(
        from_key("key").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
