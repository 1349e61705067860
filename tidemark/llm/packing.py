"""Packing of documents into sequences by minimum bin slack.

A document's ids are cut at every ``capacity`` ids; these pieces fill a sequence
each. What remains of the documents, one piece of less than a sequence each, is a multiset of
at most ``capacity - 1`` lengths, however many documents there are. It is packed window by window:
the longest length left opens a window, a subset-sum program over
bitsets (one bit a total) finds the multiset of lengths that fills the rest of the
window closest, and going back through the bitsets gives how often each length is
taken. The same filling is repeated until one of its lengths runs out, so the plan
has a few fillings a length, not one a window.

If the best filling leaves more than ``SLACK`` ids of padding, one more piece is cut: its head closes
the window and its tail is a length of the multiset again.

The plan speaks of "the k-th piece of length l". Pieces are numbered by length
with range partitions, so a length that a third of the documents share is split, and
each finds its sequence and offset by arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import codec, default_path
from tidemark.llm.common import doc_key, from_key, read_documents, saved, small_batches, text_of
from tidemark.operators.sequence import keyed_running

CAPACITY = 1024
SLACK = 8            # ids of padding that a window may keep
END_ID = 0           # fixed value: the id after each document
RANK_BITS = 48       # pieces of one length


def best_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, whose total comes closest to
    ``room`` from below. Longer lengths are preferred."""
    bits, steps = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, bits))
            bits |= (bits << (length * take)) & ((2 << room) - 1)
            left -= take
            take *= 2
        if bits >> room:
            break
    total, out = bits.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


class Plan:
    """Where the pieces of a multiset of lengths go, as sorted columns.

    An entry says: the pieces of ``length`` from rank ``first`` on stand, ``each`` in
    a sequence, from sequence ``sequence`` on at ``offset``. If ``head`` is less than
    the length, only so many ids do, and the tail is the piece of rank ``tail`` on
    of the rest's length.
    """

    COLUMNS = ("length", "first", "each", "sequence", "offset", "head", "tail")

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, slack: int = SLACK):
        left = {x: n for x, n in counts.items() if x and n}
        made, used = dict(left), dict.fromkeys(left, 0)     # ranks given out, and those placed
        entries, self.sequences = [], 0
        while left:
            seed = max(left)
            left[seed] -= 1
            taken = best_filling(left, capacity - seed)
            left[seed] += 1
            taken[seed] = taken.get(seed, 0) + 1
            room = capacity - sum(x * n for x, n in taken.items())
            cut = 0
            if room > slack:
                others = {x for x, n in left.items() if n > taken.get(x, 0)}     # all are longer than the room
                cut = max(others, default=0)
            need = dict(taken)
            if cut:
                need[cut] = need.get(cut, 0) + 1
            times = min(left[x] // n for x, n in need.items())
            offset = 0
            for x, n in sorted(taken.items(), reverse=True):
                entries.append((x, used[x], n, self.sequences, offset, x, 0))
                used[x] += n * times
                offset += n * x
            if cut:
                rest = cut - room
                entries.append((cut, used[cut], 1, self.sequences, offset, room, made.get(rest, 0)))
                used[cut] += times
            for x, n in need.items():
                left[x] -= n * times
            if cut:
                made[rest] = made.get(rest, 0) + times
                used.setdefault(rest, 0)
                left[rest] = left.get(rest, 0) + times
            left = {x: n for x, n in left.items() if n}
            self.sequences += times
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, len(self.COLUMNS))
        for i, name in enumerate(self.COLUMNS):
            setattr(self, name, table[:, i])
        self.keys = (self.length << RANK_BITS) + self.first

    def pieces(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, ids before it, length, sequence, offset) of the pieces that rows of
        (length, rank) are put in, as arrays; a cut piece comes again with its tail."""
        row = np.arange(len(length))
        before = np.zeros(len(length), np.int64)
        while len(row):
            at = np.searchsorted(self.keys, (length << RANK_BITS) + rank, side="right") - 1
            k = rank - self.first[at]
            each, head = self.each[at], self.head[at]
            yield row, before, head, self.sequence[at] + k // each, self.offset[at] + k % each * length
            cut = head < length
            row, before, length, rank = row[cut], (before + head)[cut], (length - head)[cut], (self.tail[at] + k)[cut]


def document_ids(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """key, doc_tokens, n_full, rest, tie, crcs, ids: of every row its ids' number, the whole
    pieces and what remains, the CRC-32 of all ids and of each whole piece, and the
    remaining ids (all of them ``with_ids``) as little-endian numbers."""
    small_batches(docs.sparkSession)
    with open(path or default_path(), encoding="utf-8") as f:
        definition = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32
        c = codec(definition)
        for b in batches:
            out = []
            for text in b.column(1):
                ids = np.array([*c.encode(text.as_py()), END_ID], "<u4")
                full = len(ids) // capacity
                out.append((len(ids), full, len(ids) % capacity, crc32(ids.tobytes()),
                            [crc32(ids[i * capacity:(i + 1) * capacity].tobytes()) for i in range(full)],
                            ids[0 if with_ids else full * capacity:].tobytes()))
            cols = [pa.array(x, kind) for x, kind in zip(zip(*out), [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()])]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["key", "doc_tokens", "n_full", "rest", "tie", "crcs", "ids"])

    return docs.select(doc_key().alias("key"), text_of().alias("text")).mapInArrow(
        run, "key bigint, doc_tokens bigint, n_full bigint, rest bigint, tie bigint, crcs array<bigint>, ids binary")


def packed_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, slack: int = SLACK,
                  with_ids: bool = False) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ``ids`` of every piece.

    Every id of every row lies in one piece; a sequence's pieces follow each other
    from offset 0 on and have at most ``capacity`` ids together. Null text counts as empty: such a row has the
    end's id alone. A null id counts as the smallest; repeated rows are packed each. An
    empty table gives no rows. Columns beside doc_id and text are not read.
    """
    coded = saved(document_ids(docs, path, capacity, with_ids), "packing-ids")
    # At most ``capacity`` rows, whatever the documents.
    totals = sorted((r["rest"], r["n"], r["full"]) for r in
                    coded.groupBy("rest").agg(F.count("*").alias("n"), F.sum("n_full").alias("full")).collect())
    plan = Plan({rest: n for rest, n, _ in totals}, capacity, slack)
    starts = np.zeros(capacity, np.int64)       # the sequence of a rest's first whole piece
    at = plan.sequences
    for rest, _, full in totals:
        starts[rest] = at
        at += full
    ranked = keyed_running(coded, ["rest"], ["key", "tie"], sums=["n_full"], seq_col="rank")
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32
        for b in batches:
            key, tokens, full, rest, rank, through = (b.column(x).to_numpy(zero_copy_only=False) for x in (
                "key", "doc_tokens", "n_full", "rest", "rank", "running_n_full"))
            whole = np.repeat(np.arange(b.num_rows), full)
            place = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
            crcs = b.column("crcs").flatten().to_numpy(zero_copy_only=False)
            parts = [(whole, place * capacity, np.full(len(whole), capacity), starts[rest[whole]] + (through - full)[whole] + place,
                      np.zeros(len(whole), np.int64), crcs)]
            ids = [np.frombuffer(x.as_py(), "<u4") for x in b.column("ids")]
            begin = tokens - np.array([len(x) for x in ids], np.int64)      # ids that are not at hand
            open_ = np.flatnonzero(rest)
            for row, before, length, sequence, offset in plan.pieces(rest[open_], rank[open_] - 1):
                row = open_[row]
                start = full[row] * capacity + before
                found = [crc32(ids[r][s - begin[r]:s - begin[r] + n].tobytes())
                         for r, s, n in zip(row.tolist(), start.tolist(), length.tolist())]
                parts.append((row, start, length, sequence, offset, np.array(found, np.int64)))
            row, start, length, sequence, offset, crc = (np.concatenate(x) for x in zip(*parts))
            cols = [key[row], start, length, crc, tokens[row], sequence, offset]
            cols = [pa.array(x, pa.int64()) for x in cols]
            if with_ids:
                cols.append(pa.array([ids[r][s:s + n].astype(np.int32) for r, s, n in zip(row, start, length)], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = ", ".join(f"`{x}` bigint" for x in names[:7]) + (", ids array<int>" if with_ids else "")
    return ranked.mapInArrow(run, schema)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packed_pieces(read_documents(spark, sf_dir)).select(
        from_key("key").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
