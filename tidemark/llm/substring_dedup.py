"""Substring dedup by seed and extend.

A window is ``LENGTH`` words in a row; words covered by a window that also
starts earlier in the corpus are removed.

1. *Anchors*: of every window the smallest hash of ``GRAM`` words is picked (the
   rightmost of equal ones), so equal windows pick the same words at the same
   place. About one word in six is an anchor.
2. *Seeds*: documents are joined on anchors; one that occurs only once cannot
   lie in a repeat and is dropped.
3. *Extension*: a seed is extended both ways over all the windows that picked it,
   and neighbouring seeds inside a repeat run together into one block. Blocks
   of equal words meet: all but the first are repeats as a whole. The first of a
   class is one too as far as blocks of other classes share its windows; only where
   its seeds occur more often than its class does are its windows compared one by one.
4. *Maximal repeats*: the removed windows of a document run together.

Nothing pairs occurrences with each other: classes are pre-aggregated to
their first occurrence, which joins back to the members. Hashes of runs have 96
bits. Text moves through one shuffle that three joins share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import apart, doc_key, from_key, packed, read_documents, small_batches, text_of, unpacked
from tidemark.llm.words import joined, runs, words

LENGTH = 20
GRAM = 8
EDGE = 2      # seeds at either end of a row of seeds that stay blocks of their own


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    least, covered = values, 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


class Anchors:
    """Anchors of some texts: text number, place of the anchor, first and last
    window that picked it (word numbers in the piece), and its hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
        starts, _, self.hashes = words(data)
        self.text = np.searchsorted(offsets, starts, side="right") - 1
        self.first_word = np.searchsorted(self.text, np.arange(len(offsets)))
        n, none = len(starts) - length + 1, np.empty(0, np.int64)
        self.of = self.at = self.low = self.high = none
        self.hash = np.empty(0, np.uint64)
        if n <= 0:
            return
        grams = runs(self.hashes, np.arange(len(starts) - gram + 1), gram)
        width = length - gram + 1
        least = sliding_min(grams, width)
        pick, window = np.zeros(n, np.int64), np.arange(n)
        for o in range(width):   # the last that equals the minimum stays
            same = grams[o:o + n] == least
            pick[same] = window[same] + o
        inside = self.text[:n] == self.text[length - 1:]
        window, pick = window[inside], pick[inside]
        if not len(pick):
            return
        new = np.ones(len(pick), bool)
        new[1:] = pick[1:] != pick[:-1]
        last = np.append(np.flatnonzero(new)[1:] - 1, len(pick) - 1)
        self.at, self.low, self.high = pick[new], window[new], window[last]
        self.of, self.hash = self.text[self.at], grams[self.at]

    def local(self, word: np.ndarray, of: np.ndarray) -> np.ndarray:
        return word - self.first_word[of]


def _pieces(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[int, int, Anchors]]:
    """(first row, rows, anchors) of a batch's texts, a bounded number of bytes a time."""
    for first, held, data, offsets in joined(texts):
        yield first, len(held), Anchors(data, offsets, length, gram)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _int(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int32))


def _second(hashes: np.ndarray) -> pa.Array:
    return pa.array((hashes >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _flat(column: pa.ListArray, first: int, n: int) -> tuple[np.ndarray, pa.StructArray]:
    """(row counted from ``first``, members) of the list column's rows."""
    part = column.slice(first, n)
    lengths = np.diff(part.offsets.to_numpy(zero_copy_only=False))
    return np.repeat(np.arange(n), lengths), part.flatten()


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(anchor, key, at) of (key, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for first, _, a in _pieces([t.as_py() for t in b.column(1)], length, gram):
                yield pa.RecordBatch.from_arrays(
                    [_long(a.hash), pa.array(keys[first + a.of]), _int(a.local(a.at, a.of))], ["anchor", "key", "at"])

    return docs.select("key", F.col("text").cast("binary")).mapInArrow(run, "anchor bigint, key bigint, at int")


def blocks(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(h1, h2, key, low, size, n) of (key, packed, seeds) rows: blocks of
    ``size`` words from word ``low`` on, whose seeds occur ``n`` times each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for first, count, a in _pieces(unpacked(b.column(1)), length, gram):
                row, seeds = _flat(b.column(2), first, count)
                place = (row << 32) | seeds.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
                n = seeds.field("n").to_numpy(zero_copy_only=False)
                order = np.argsort(place, kind="stable")
                place, n = place[order], n[order]
                mine = (a.of << 32) | a.local(a.at, a.of)
                found = np.minimum(np.searchsorted(place, mine), max(len(place) - 1, 0))
                keep = np.flatnonzero(place[found] == mine) if len(place) else np.empty(0, np.int64)
                if not len(keep):
                    continue
                times, of = n[found[keep]], a.of[keep]
                start = np.ones(len(keep), bool)
                start[1:] = (keep[1:] != keep[:-1] + 1) | (times[1:] != times[:-1]) | (of[1:] != of[:-1])
                stop = np.append(start[1:], True)
                # Seeds near either end of a row of seeds stand alone, the others form one block.
                alone = np.zeros(len(keep), bool)
                for e in range(EDGE):
                    alone[e:] |= start[:len(keep) - e]
                    alone[:len(keep) - e] |= stop[e:]
                start |= alone
                start[1:] |= alone[:-1]
                begin = np.flatnonzero(start)
                end = np.append(begin[1:] - 1, len(keep) - 1)
                low = a.low[keep[begin]]
                size = a.high[keep[end]] - low + length
                h1, h2 = runs(a.hashes, low, size, 1), runs(a.hashes, low, size, 2)
                at = of[begin]
                yield pa.RecordBatch.from_arrays(
                    [_long(h1), _second(h2), pa.array(keys[first + at]), _int(a.local(low, at)), _int(size),
                     pa.array(times[begin])], ["h1", "h2", "key", "low", "size", "n"])

    return rows.select("key", "packed", "seeds").mapInArrow(
        run, "h1 bigint, h2 int, key bigint, low int, size int, n bigint")


def windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(h1, h2, key, low) of every window inside the blocks of (key, packed, parts) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for first, held, data, offsets in joined(unpacked(b.column(1))):
                starts, _, hashes = words(data)
                text = np.searchsorted(offsets, starts, side="right") - 1
                first_word = np.searchsorted(text, np.arange(len(offsets)))
                row, parts = _flat(b.column(2), first, len(held))
                low = parts.field("low").to_numpy(zero_copy_only=False).astype(np.int64)
                n = parts.field("size").to_numpy(zero_copy_only=False).astype(np.int64) - length + 1
                within = low + n + length - 1 <= np.diff(first_word)[row]
                row, low, n = row[within], low[within], n[within]
                if not len(n):
                    continue
                at = np.repeat(first_word[row] + low - np.cumsum(n) + n, n) + np.arange(n.sum())
                row = np.repeat(row, n)
                place = np.unique((row << 32) | (at - first_word[row]))
                row, local = place >> 32, place & 0xFFFFFFFF
                at = first_word[row] + local
                yield pa.RecordBatch.from_arrays(
                    [_long(runs(hashes, at, length, 1)), _second(runs(hashes, at, length, 2)),
                     pa.array(keys[first + row]), _int(local)], ["h1", "h2", "key", "low"])

    return rows.select("key", "packed", "parts").mapInArrow(
        run, "h1 bigint, h2 int, key bigint, low int")


def _against_first(rows: DataFrame) -> DataFrame:
    """``rows`` with the first occurrence of their hash (``first``; null where
    there is one only) and how many there are (``members``)."""
    classes = rows.groupBy(F.col("h1").alias("c1"), F.col("h2").alias("c2")).agg(
        F.min(F.struct("key", "low")).alias("first"), F.count("*").alias("members")).filter("members > 1")
    return rows.join(classes, (apart("h1") == apart("c1")) & (F.col("h2") == F.col("c2")), "left").drop("c1", "c2")


def repeats(texts: DataFrame, dealt: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, low, size): all repeated windows, in blocks, of (key, text) rows; ``dealt``: the same texts, packed."""
    found = anchors(texts, length, gram)
    often = found.groupBy(F.col("anchor").alias("a")).agg(F.count("*").alias("n")).filter("n > 1")
    seeds = (found.join(often, apart("anchor") == apart("a")).groupBy(F.col("key").alias("k"))
             .agg(F.collect_list(F.struct("at", "n")).alias("seeds")))
    held = _against_first(blocks(dealt.join(seeds, F.col("key") == F.col("k")), length, gram))
    later = (F.col("first.key") != F.col("key")) | (F.col("first.low") != F.col("low"))
    is_later = F.coalesce(later, F.lit(False))
    whole = held.filter(is_later).select("key", "low", "size")
    parts = (held.filter(~is_later & (F.coalesce("members", F.lit(1)) < F.col("n"))).groupBy(F.col("key").alias("k"))
             .agg(F.collect_list(F.struct("low", "size")).alias("parts")))
    single = _against_first(windows(dealt.join(parts, F.col("key") == F.col("k")), length))
    single = single.filter(is_later).select("key", "low", F.lit(length).alias("size"))
    return whole.unionByName(single)


def _kept(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(words, words removed, kept words joined by a space)."""
    every = text.split()
    edge = np.zeros(len(every) + 1, np.int64)
    for low, size in spans:
        if low < len(every):
            edge[low] += 1
            edge[min(low + size, len(every))] -= 1
    keep = (np.cumsum(edge[:-1]) == 0).tolist()
    kept = [w for w, k in zip(every, keep) if k] if spans else every
    return len(every), len(every) - len(kept), b" ".join(kept)


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """key, n_words, n_removed, kept_sha256 and, unless told otherwise, ``kept`` of every row.

    Null text has no words. A null id counts as the smallest. Rows that share
    an id are one document: none of their equal windows is the earlier
    one at the same place, and words that are removed in one of them are removed
    at these places in all. Repeated rows each get their row; an empty table
    gives none. Columns beside doc_id and text are not read.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be 1 to length")
    small_batches(docs.sparkSession)
    texts = docs.select(doc_key().alias("key"), text_of().alias("text"))
    dealt = packed(texts)
    spans = repeats(texts, dealt, length, gram).groupBy(F.col("key").alias("k")).agg(
        F.collect_list(F.struct("low", "size")).alias("spans"))
    rows = dealt.join(spans, F.col("key") == F.col("k"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        for b in batches:
            done = [_kept(t, [(s["low"], s["size"]) for s in (found.as_py() or ())])
                    for t, found in zip(unpacked(b.column(1)), b.column(2))]
            cols = [b.column(0), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                    pa.array([sha256(d[2]).hexdigest() for d in done], pa.string())]
            if with_text:
                cols.append(pa.array([d[2] for d in done], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names)

    names = ["key", "n_words", "n_removed", "kept_sha256"] + (["kept"] if with_text else [])
    schema = "key bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept binary" if with_text else "")
    out = rows.select("key", "packed", "spans").mapInArrow(run, schema)
    return out.withColumn("kept", F.col("kept").cast("string")) if with_text else out


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return deduplicated(read_documents(spark, sf_dir), with_text=False).select(
        from_key("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS run
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS k FROM g) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, s + o AS i FROM r, (SELECT unnest(range(0, 20)) AS o)),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
k AS (SELECT x.doc_id, count(c.i) AS n_removed,
             string_agg(x.word, ' ' ORDER BY x.i) FILTER (WHERE c.i IS NULL) AS kept
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.i = c.i GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
