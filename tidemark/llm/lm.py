"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a trigram model with interpolated absolute discounting over all
words of the corpus. The most frequent words are numbered and known to every
task; any other word is its hash. A token c after a b is scored by a sum,

    log P(c | a b) = L(c) + W(b) + G(b c) + W(a b) + G(a b c),

its share of all tokens, then what each n-gram that was seen adds: W is the
mass that a context leaves to what it was not seen with, G the gain of a seen
n-gram over the back-off. N-grams that were not seen add nothing.

The n-grams are dealt over shards of the corpus's size by the middle word b of
their triple, so a shard knows all that begins or ends with its words. A word of
more than 1 / HOT of a shard would be too much for one: its triples are dealt by
(a, b), those of BEGIN by c, and its pairs (b, c) are summed up by c, as are the
counts of the words without a number. Tasks sum up triples before anything is
shuffled; nothing but the numbered words and the hot words' totals, both of a
bounded number, passes through the driver.

A shard's trie has Elias-Fano sequences: its symbols; the words b; their
followers c and their contexts a as children of b; the triples as children of a
context, each as its place among the followers of b. Children are stored relative
to their parent and carried on from row to row, so that a level is one monotone
sequence, with monotone pointers. Gains and weights have eight bits. The
distinct triples of the documents are sent to the shards, which search for those of
many batches together, in order, in the mapped levels: a child's successor between
the pointers of its context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import doc_key, from_key, held_out, read_documents, removed, saved, saved_dealt, scratch, small_batches, text_of
from tidemark.llm.eliasfano import EliasFano, mapped, quantised, read_quantised, to_bytes
from tidemark.llm.words import joined, mixed, words

BITS = 20
SYMBOLS = 1 << BITS
BEGIN, END, FIRST = 1, 2, 3      # 0 stands before BEGIN
RARE = 1 << 62              # a word without a number is this bit and its hash
KNOWN = SYMBOLS - FIRST     # most frequent words, which are numbered
HOT = 4
SHARD_TOKENS = 1_250_000    # corpus tokens a shard
BATCH = 3 << 20             # bytes of text whose triples are sorted together
HELD = 500_000              # triples a task sums up at once
ASKS = 400_000              # triples a shard searches for at once
ALPHA = 0.1                 # added to a word's count
PIECES = 2_000              # buckets the shards are dealt into, at most
HELD_OUT = 10               # documents whose crc32 leaves 0 by this are not learned from


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, compressed byte by byte; the first one rises and is stored as steps."""
    from zstandard import ZstdCompressor
    parts = [np.diff(arrays[0], prepend=arrays[0].dtype.type(0)), *arrays[1:]]
    return ZstdCompressor(level=1).compress(b"".join(
        np.ascontiguousarray(p).view(np.uint8).reshape(len(p), p.dtype.itemsize).T.tobytes() for p in parts))


def _unpack(block: bytes, n: int, *kinds) -> list[np.ndarray]:
    from zstandard import ZstdDecompressor
    raw, at, out = np.frombuffer(ZstdDecompressor().decompress(block), np.uint8), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.add.reduceat(counts, at)


def _rare(hashes: np.ndarray) -> np.ndarray:
    """The symbols of words without a number; they rise with the hashes."""
    return (hashes >> np.uint64(2)).astype(np.int64) | RARE


class Vocabulary:
    """Counts and symbols of the most frequent words, found by their hashes."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.words, self.counts, self.symbols = arrays["words"], arrays["counts"], arrays["symbols"]
        top = (self.words >> np.uint64(64 - BITS)).astype(np.int64)
        self.starts = np.searchsorted(top, np.arange(SYMBOLS + 1))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word, or -1."""
        bucket = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
        at, last = self.starts[bucket], self.starts[bucket + 1]
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.flatnonzero(at < last)
        while len(open_):
            here = at[open_]
            hit = self.words[here] == hashes[open_]
            out[open_[hit]] = here[hit]
            at[open_] += 1
            open_ = open_[~hit & (here + 1 < last[open_])]
        return out


class Stream:
    """Token symbols of some texts: each text is BEGIN, its words, END."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary):
        starts, _, self.hashes = words(data)
        self.word_text = np.searchsorted(offsets, starts, side="right") - 1
        n = len(offsets) - 1
        first = np.searchsorted(self.word_text, np.arange(n + 1))
        self.sizes = np.diff(first)
        self.places = vocabulary.places(self.hashes)
        self.symbols = np.empty(len(starts) + 2 * n, np.int64)
        self.text = np.repeat(np.arange(n), self.sizes + 2)
        begin = first[:-1] + 2 * np.arange(n)
        self.symbols[begin], self.symbols[begin + self.sizes + 1] = BEGIN, END
        known = vocabulary.symbols[self.places] if len(vocabulary.words) else 0
        self.symbols[np.arange(len(starts)) + 2 * self.word_text + 1] = np.where(self.places >= 0, known, _rare(self.hashes))


def _streams(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, text: int) -> Iterator[tuple]:
    """(the other columns' values by text, stream), about BATCH bytes a time."""
    held: list[bytes] = []
    rows: list[list] = []
    size = 0

    def out():
        for first, part, data, offsets in joined(held, BATCH):
            yield [np.concatenate(c)[first:first + len(part)] for c in zip(*rows)], Stream(data, offsets, vocabulary)

    for b in batches:
        held += [(t.as_py() or b"").lower() for t in b.column(text)]
        rows.append([c.to_numpy(zero_copy_only=False) for i, c in enumerate(b.columns) if i != text])
        size += b.column(text).nbytes
        if size >= BATCH:
            yield from out()
            held, rows, size = [], [], 0
    if held:
        yield from out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs, by its hash, over (text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys, counts):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["word", "n"])

        keys, counts, new = np.empty(0, np.uint64), np.empty(0, np.int64), []
        for b in batches:
            for _, _, data, _ in joined([(t.as_py() or b"").lower() for t in b.column(0)]):
                new.append(np.unique(words(data)[2], return_counts=True))
            if sum(len(k) for k, _ in new) > 1_000_000:
                keys, counts = _summed(np.concatenate([keys, *[k for k, _ in new]]),
                                       np.concatenate([counts, *[c for _, c in new]]))
                new = []
                if len(keys) > 2_000_000:
                    yield out(keys, counts)
                    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        keys, counts = _summed(np.concatenate([keys, *[k for k, _ in new]]), np.concatenate([counts, *[c for _, c in new]]))
        if len(keys):
            yield out(keys, counts)

    rows = texts.select(F.col("text").cast("binary")).mapInArrow(run, "word bigint, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, at most ``most``: (hash, count), most frequent
    first. Found from a histogram over the logarithm of the counts, at most some 4000 rows."""
    step = F.floor(F.log2("n") * 64)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("b")).agg(F.count("*").alias("w")).collect(), key=lambda r: -r.b):
        total += r.w
        if total > most:
            break
        least = r.b
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    got = counts.filter(step >= least).toArrow()
    word = got.column("word").to_numpy().view(np.uint64)
    n = got.column("n").to_numpy()
    order = np.lexsort((word, -n))
    return word[order], n[order]


def _triples(s: Stream) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(b, a, c, text) of every token c but BEGIN, which follows a and b."""
    x = s.symbols
    at = np.flatnonzero(x != BEGIN)
    b = x[at - 1]
    return b, np.where(b == BEGIN, 0, x[at - 2]), x[at], s.text[at]


def _order(b: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """An order that brings equal triples together: first those of numbered
    symbols, sorted, then those with a hash, sorted."""
    wide = (b | a | c) >= SYMBOLS
    plain, other = np.flatnonzero(~wide), np.flatnonzero(wide)
    key = (b[plain] << 2 * BITS) | (a[plain] << BITS) | c[plain]
    return np.concatenate([plain[np.argsort(key)], other[np.lexsort((c[other], a[other], b[other]))]])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _summed_triples(b: np.ndarray, a: np.ndarray, c: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    order = _order(b, a, c)
    b, a, c, n = b[order], a[order], c[order], n[order]
    at = _starts(b, a, c)
    return [b[at], a[at], c[at], np.add.reduceat(n, at) if len(at) else n]


def _pairs(b: np.ndarray, c: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs (b, c) with their counts, and the pair of each triple."""
    order = _order(b, np.zeros(len(b), np.int64), c)
    at = _starts(b[order], c[order])
    back = np.empty(len(b), np.int64)
    back[order] = np.repeat(np.arange(len(at)), _lengths(at, len(b)))
    return b[order][at], c[order][at], np.add.reduceat(n[order], at) if len(at) else n, back


def _pack_triples(b: np.ndarray, a: np.ndarray, c: np.ndarray, n: np.ndarray) -> bytes:
    """Triples in their order with a number each: those of numbered symbols as one key."""
    k = int(np.count_nonzero((b | a | c) < SYMBOLS))
    plain = _pack(((b[:k] << 2 * BITS) | (a[:k] << BITS) | c[:k]).astype(np.uint64), n[:k])
    return np.array([k, len(plain)], np.int64).tobytes() + plain + _pack(b[k:], a[k:], c[k:], n[k:])


def _unpack_triples(block: bytes, n: int, kind) -> list[np.ndarray]:
    k, size = (int(x) for x in np.frombuffer(block[:16], np.int64))
    key, m = _unpack(block[16:16 + size], k, np.int64, kind)
    wide = _unpack(block[16 + size:], n - k, np.int64, np.int64, np.int64, kind)
    plain = (key >> 2 * BITS, (key >> BITS) & (SYMBOLS - 1), key & (SYMBOLS - 1), m)
    return [np.concatenate(x) for x in zip(plain, wide)]


def _deal(symbols: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(symbols.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _home(b: np.ndarray, a: np.ndarray, c: np.ndarray, hot: int, shards: int) -> np.ndarray:
    """The shard of each triple; symbols below ``hot`` are dealt by (a, b), BEGIN by c."""
    other = mixed(np.where(b == BEGIN, c, a).astype(np.uint64))
    return _deal(np.where(b < hot, other + b.astype(np.uint64), b.astype(np.uint64)), shards)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places in it, in their order)."""
    small = len(shard) and shard.max() < 1 << 15           # sorted by radix
    order = np.argsort(shard.astype(np.int16) if small else shard, kind="stable")
    cuts = _starts(shard[order])
    for low, high in zip(cuts, [*cuts[1:], len(order)]):
        yield int(shard[order[low]]), order[low:high]


def _asking(b: np.ndarray, c: np.ndarray, hot: int, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of the pairs of which a shard must be told: the count of a
    pair that begins with a hot word, or of a second word without a number."""
    at = np.flatnonzero((b < hot) | (c >= RARE))
    at = at[np.lexsort((b[at], c[at]))]
    for k, mine in _by_shard(_deal(c[at], shards)):
        yield k, at[mine]


TRIPLES = [("shard", pa.int32()), ("source", pa.int32()), ("n", pa.int32()), ("block", pa.binary()),
           ("stats", pa.list_(pa.int64())), ("kinds", pa.map_(pa.int32(), pa.int64()))]
TRIPLES_DDL = "shard int, source int, n int, block binary, stats array<bigint>, kinds map<int,bigint>"


def triple_counts(texts: DataFrame, vocabulary: Broadcast, hot: int, shards: int) -> DataFrame:
    """(shard, source, n, block, stats): with source -1 the distinct triples of
    each shard with their counts, and how many triples and pairs of its own occur
    once and twice; else what the shard ``source`` asks this one."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(mapped(vocabulary.value))

        def out(held: list) -> pa.RecordBatch:
            found = _summed_triples(*(np.concatenate(x) for x in zip(*held)))
            found[3] = found[3].astype(np.uint32)
            return _batch([(k, len(at), _pack_triples(*(x[at] for x in found)))
                           for k, at in _by_shard(_home(*found[:3], hot, shards))], PARTS)

        held, size = [], 0
        for _, s in _streams(batches, v, 0):
            b, a, c, _ = _triples(s)
            held.append((b, a, c, np.ones(len(b), np.uint32)))
            size += len(b)
            if size > HELD:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    def merge(table: pa.Table) -> pa.Table:
        got = [_unpack_triples(b.as_py(), n.as_py(), np.uint32) for n, b in zip(table["n"], table["block"])]
        b, a, c, n = (np.concatenate(x) for x in zip(*got))
        found = b, _, c, n = _summed_triples(b, a, c, n.astype(np.int64))
        del got
        first, second, times, _ = _pairs(b, c, n)
        own = times[first >= hot]
        counted = n[(b != BEGIN) | (c == END)]
        me = table["shard"][0].as_py()
        rows = [(me, -1, len(b), _pack_triples(*found), [int((x == k).sum()) for x in (counted, own) for k in (1, 2)], None)]
        for k, at in _asking(first, second, hot, shards):
            is_hot = first[at] < hot
            rows.append((k, me, len(at), _pack(second[at], np.where(is_hot, first[at], 0).astype(np.uint32),
                                               np.where(is_hot, times[at], 0)), None, None))
        return pa.Table.from_batches([_batch(rows, TRIPLES)])

    parts = texts.select(F.col("text").cast("binary")).mapInArrow(count, "shard int, n int, block binary")
    return parts.groupBy("shard").applyInArrow(merge, TRIPLES_DDL)


PARTS = [("shard", pa.int32()), ("n", pa.int32()), ("block", pa.binary())]


def told(asked: DataFrame, rest: DataFrame) -> DataFrame:
    """(shard, source, n, block, stats, kinds): the answers of the shard ``source``
    to what this one asked, in its order: counts of pairs and of second words. With
    source -1 the pairs of hot words that this shard has summed up, how many of
    them occur once and twice, and how many each hot word among them has."""
    def answer(asks: pa.Table, words: pa.Table) -> pa.Table:
        word, count = np.empty(0, np.uint64), np.empty(0, np.int64)
        for n, block in zip(words["n"], words["words"]):
            word, count = _unpack(block.as_py(), n.as_py(), np.uint64, np.int64)
        if not asks.num_rows:
            return pa.Table.from_batches([_batch([], TRIPLES)])
        got = [_unpack(b.as_py(), n.as_py(), np.int64, np.uint32, np.int64) for b, n in zip(asks["block"], asks["n"])]
        c, b, n = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((b, c))
        at = _starts(c[order], b[order])
        back = np.empty(len(c), np.int64)
        back[order] = np.repeat(np.arange(len(at)), _lengths(at, len(c)))
        c, b, total = c[order][at], b[order][at], np.add.reduceat(n[order], at)
        place = _look(_rare(word), c)
        alone = np.where(place >= 0, count[place] if len(count) else 0, 0)
        me, rows, low = asks["shard"][0].as_py(), [], 0
        for source, (x, _, _) in zip(asks["source"], got):
            mine = back[low:low + len(x)]
            low += len(x)
            rows.append((source.as_py(), me, len(x), _pack(np.zeros(len(x), np.uint8), total[mine], alone[mine]), None, None))
        real = b > 0
        kinds = zip(*(x.tolist() for x in np.unique(b[real], return_counts=True)))
        rows.append((me, -1, int(real.sum()), _pack(c[real], b[real], total[real], alone[real]),
                     [int((total[real] == k).sum()) for k in (1, 2)], list(kinds)))
        return pa.Table.from_batches([_batch(rows, TRIPLES)])

    return asked.groupBy("shard").cogroup(rest.groupBy("shard")).applyInArrow(answer, TRIPLES_DDL)


def _discount(once: int, twice: int) -> float:
    return min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _rows_of_children(parent: np.ndarray, child: np.ndarray, parents: int, name: str) -> dict[str, np.ndarray]:
    """Pointers of all parents and their children, relative to the parent and
    carried on from row to row; sorted by (parent, child)."""
    pointers = np.searchsorted(parent, np.arange(parents + 1))
    lasts = np.zeros(parents, np.int64)
    filled = np.diff(pointers) > 0
    lasts[filled] = child[pointers[1:][filled] - 1] + 1
    base = np.cumsum(lasts) - lasts
    return EliasFano.parts(pointers, f"{name}.pointers") | EliasFano.parts(base[parent] + child, f"{name}.children")


def _look(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each number among rising keys, or -1."""
    if not len(keys):
        return np.full(len(asked), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


class Head:
    """What every task knows: counts by symbol, and of hot symbols (those below
    ``hot``) the followers."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.counts, self.kinds = arrays["by_symbol"], arrays["kinds"]
        self.hot = len(self.kinds)
        self.d2, self.d3, self.every = (float(x) for x in arrays["numbers"])
        self.ends = int(self.counts[END])
        self.left = np.log10(self.mass(self.kinds, self.counts[:self.hot]))

    def mass(self, kinds: np.ndarray, total: np.ndarray) -> np.ndarray:
        """What a word with so many followers leaves to others."""
        return np.where(kinds > 0, self.d2 * kinds / np.maximum(total, 1), 1.0)

    def alone(self, symbols: np.ndarray, told: np.ndarray) -> np.ndarray:
        """The share of each symbol of all tokens; ``told`` has the counts of words without a number."""
        n = np.where(symbols < RARE, self.counts[np.minimum(symbols, len(self.counts) - 1)], told)
        return (n + ALPHA) / self.every


def _hot_pairs(c: np.ndarray, b: np.ndarray, n: np.ndarray, told: np.ndarray, h: Head) -> dict[str, np.ndarray]:
    """The gains of the pairs of hot words, by their second symbol."""
    first, left = h.alone(c, told), 10 ** h.left[b]
    p = np.maximum(n - h.d2, 0) / np.maximum(h.counts[b], 1) + left * first
    symbols, row = np.unique(c, return_inverse=True)
    return (EliasFano.parts(symbols, "symbols") | _rows_of_children(row, b.astype(np.int64), len(symbols), "pairs")
            | quantised(np.log10(p / (left * first)), "pair"))


def _levels(b: np.ndarray, a: np.ndarray, c: np.ndarray, n: np.ndarray, answers: dict[int, list[np.ndarray]],
            shards: int, h: Head) -> dict[str, np.ndarray]:
    """A shard's trie."""
    first, second, pair_n, pair = _pairs(b, c, n)
    told_n = np.zeros(len(first), np.int64)
    for k, at in _asking(first, second, h.hot, shards):
        _, total, alone = answers[k]
        pair_n[at] = np.where(first[at] < h.hot, total, pair_n[at])
        told_n[at] = alone
    share = h.alone(second, told_n)
    symbols = np.sort(np.concatenate([first, second, a]))
    symbols = symbols[_starts(symbols)]
    word, child = np.searchsorted(symbols, first), np.searchsorted(symbols, second)
    order = np.argsort((word << 32) | child)
    heads, row = np.unique(word[order], return_inverse=True)
    pair_n, share = pair_n[order], share[order]
    total, kinds = np.bincount(row, pair_n, len(heads)), np.bincount(row, minlength=len(heads))
    hot = np.flatnonzero(symbols[heads] < h.hot)
    total[hot], kinds[hot] = h.counts[symbols[heads[hot]]], h.kinds[symbols[heads[hot]]]
    left = h.mass(kinds, total)
    p2 = np.maximum(pair_n - h.d2, 0) / np.maximum(total[row], 1) + left[row] * share
    out = (EliasFano.parts(symbols, "symbols") | EliasFano.parts(heads, "heads") | {"left": np.log10(left).astype(np.float32)}
           | _rows_of_children(row, child[order], len(heads), "pairs") | quantised(np.log10(p2 / (left[row] * share)), "pair"))
    # From here on pairs are known by their place in the order of the level.
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    among = np.arange(len(order)) - np.searchsorted(row, np.arange(len(heads)))[row]
    real = b != BEGIN
    pair, n = place[pair[real]], n[real]
    contexts, context = np.unique((row[pair] << 32) | np.searchsorted(symbols, a[real]), return_inverse=True)
    total, kinds = np.bincount(context, n, len(contexts)), np.bincount(context, minlength=len(contexts))
    weight = h.d3 * kinds / np.maximum(total, 1)
    below = weight[context] * p2[pair]
    gain = np.log10((np.maximum(n - h.d3, 0) / total[context] + below) / below)
    order = np.argsort((context << 32) | among[pair])
    return (out | _rows_of_children(contexts >> 32, contexts & 0xFFFFFFFF, len(heads), "contexts")
            | quantised(np.log10(weight), "weight")
            | _rows_of_children(context[order], among[pair[order]], len(contexts), "triples") | quantised(gain[order], "gain"))


def build_shards(triples: DataFrame, answers: DataFrame, head: Broadcast, shards: int) -> DataFrame:
    """(shard, levels, pairs): the trie of each shard, or the pairs of hot words it has, compressed."""
    def build(table: pa.Table, told: pa.Table) -> pa.Table:
        from zstandard import ZstdCompressor
        pack = ZstdCompressor(level=1).compress
        h, rows = Head(mapped(head.value)), []
        got = {}
        for shard, source, n, block in zip(told["shard"], told["source"], told["n"], told["block"]):
            if source.as_py() < 0:
                held = _unpack(block.as_py(), n.as_py(), np.int64, np.uint32, np.int64, np.int64)
                rows.append((shard.as_py(), None, pack(to_bytes(_hot_pairs(*held, h)))))
            else:
                got[source.as_py()] = _unpack(block.as_py(), n.as_py(), np.uint8, np.int64, np.int64)
        for shard, n, block in zip(table["shard"], table["n"], table["block"]):
            levels = _levels(*_unpack_triples(block.as_py(), n.as_py(), np.int64), got, shards, h)
            rows.append((shard.as_py(), pack(to_bytes(levels)), None))
        return pa.Table.from_batches([_batch(rows, BUILT)])

    return triples.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        build, "shard int, levels binary, pairs binary")


BUILT = [("shard", pa.int32()), ("levels", pa.binary()), ("pairs", pa.binary())]


@dataclass
class Model:
    """A trained model: tables in the shared folder and what every task gets."""

    tokens: int              # tokens learned from
    shards: int
    levels: DataFrame        # (shard, levels, pairs, n, words) in buckets by shard: tries, pairs of hot words, and the words no task has
    vocabulary: Broadcast
    head: Broadcast


def train(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Learn from the ``text`` of all rows; null counts as empty."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(text_of().alias("text"))
    documents = docs.count()
    passing = [scratch(spark, f"lm-{name}") for name in ("words", "triples", "told", "rest")]     # read until the levels are written
    counts = saved(word_counts(texts), "lm-words", passing[0], clean=True)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, distinct = total.n + documents, total.v + (documents > 0)
    word, often = _frequent(counts, KNOWN)
    order = np.argsort(word)
    vocabulary = {"words": word[order], "counts": often[order], "symbols": order + FIRST}
    shared = spark.sparkContext.broadcast(to_bytes(vocabulary))
    shards = max(1, -(-n // shard_tokens))
    # Symbols are numbered from the most frequent word on: the hot ones are the first, at most HOT a shard.
    hot = FIRST + int(np.count_nonzero(often * HOT > shard_tokens))
    rest = counts
    if len(word):
        rest = counts.filter(F.floor(F.log2("n") * 64) < F.floor(F.log2(F.lit(int(often.min()))) * 64))
    rest = saved(_word_shards(rest, shards), "lm-rest", passing[3], clean=True)
    triples = saved(triple_counts(texts, shared, hot, shards), "lm-triples", passing[1], clean=True)
    own = F.col("source") < 0
    answers = saved(told(triples.filter(~own), rest), "lm-told", passing[2], clean=True)

    def added(table: DataFrame, cells, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        for r in table.filter(own).select(cells.alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect():
            out[r.at] = r.x
        return out

    stats = F.posexplode("stats")
    seen, hot_seen = added(triples, stats, 4).tolist(), added(answers, stats, 2).tolist()
    d2, d3 = _discount(seen[2] + hot_seen[0], seen[3] + hot_seen[1]), _discount(seen[0], seen[1])
    by_symbol = np.concatenate([[0, documents, documents], often]).astype(np.int64)
    head = spark.sparkContext.broadcast(to_bytes({
        "by_symbol": by_symbol, "kinds": added(answers, F.explode("kinds"), hot), "numbers": np.array([d2, d3, n + ALPHA * (distinct + 1)])}))
    none = F.lit(None)
    levels = build_shards(triples.filter(own), answers, head, shards)
    dealt = levels.select("*", none.cast("int").alias("n"), none.cast("binary").alias("words")).unionByName(
        rest.select("shard", none.cast("binary").alias("levels"), none.cast("binary").alias("pairs"), "n", "words"))
    dealt = saved_dealt(dealt, "lm-levels", "shard", min(shards, PIECES))
    removed(spark, *passing)
    return Model(n, shards, dealt, shared, head)


def _word_shards(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, n, words): the words of each shard in order, with their counts."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = _deal(_rare(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)), shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *b.columns], ["shard", "word", "n"])

    def gather(table: pa.Table) -> pa.Table:
        word = table["word"].to_numpy().view(np.uint64)
        order = np.argsort(word)
        block = _pack(word[order], table["n"].to_numpy()[order])
        return pa.table({"shard": table["shard"][:1], "n": pa.array([len(word)], pa.int32()), "words": pa.array([block], pa.binary())})

    dealt = counts.select("word", "n").mapInArrow(deal, "shard int, word bigint, n bigint")
    return dealt.groupBy("shard").applyInArrow(gather, "shard int, n int, words binary")


ASKED = [("batch", pa.int64()), ("shard", pa.int32()), ("n", pa.int32()), ("refs", pa.int32()), ("block", pa.binary()),
         ("places", pa.binary()), ("n_pairs", pa.int32()), ("pairs", pa.binary()), ("n_words", pa.int32()), ("words", pa.binary()),
         ("own", pa.binary())]
ANSWERED = [("batch", pa.int64()), ("n", pa.int32()), ("gains", pa.binary()), ("n_words", pa.int32()), ("logs", pa.binary()),
            ("own", pa.binary())]


def questions(rows: DataFrame, model: Model) -> DataFrame:
    """What batches of (key, text) rows ask of each shard: a row for a batch and
    a shard. One row of each batch carries what needs no shard."""
    vocabulary, head, shards = model.vocabulary, model.head, model.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        v, h = Vocabulary(mapped(vocabulary.value)), Head(mapped(head.value))
        part = TaskContext.get().partitionId() << 32
        for i, ((keys,), s) in enumerate(_streams(batches, v, 1)):
            yield _asked(part + i, s, _known(s, v, h) | {"key": keys}, h.hot, shards)

    schema = ("batch bigint, shard int, n int, refs int, block binary, places binary, n_pairs int, pairs binary, "
              "n_words int, words binary, own binary")
    return rows.select("key", F.col("text").cast("binary")).mapInArrow(run, schema)


def _known(s: Stream, v: Vocabulary, h: Head) -> dict[str, np.ndarray]:
    """Sums by text of what every task can tell."""
    n, known, of = len(s.sizes), s.places >= 0, s.word_text
    log = np.zeros(len(of))
    log[known] = np.log10(v.counts[s.places[known]] + ALPHA)
    base = np.bincount(of, log, n) + np.log10(h.ends + ALPHA) - (s.sizes + 1) * np.log10(h.every)
    n_known = np.bincount(of, known, n).astype(np.int64) + (h.ends > 0)
    b, _, _, text = _triples(s)
    hot = b < h.hot
    return {"n_tokens": s.sizes + 1, "n_known": n_known, "base": base, "score": base + np.bincount(text[hot], h.left[b[hot]], n)}


def _asked(batch: int, s: Stream, own: dict[str, np.ndarray], hot: int, shards: int) -> pa.RecordBatch:
    """A row a shard: distinct triples, how many texts ask each and which (their
    numbers in the batch); pairs of hot words and words likewise."""
    b, a, c, text = _triples(s)
    at = np.flatnonzero(b < hot)
    at = at[_order(c[at], np.zeros(len(at), np.int64), b[at])]
    pair, pair_ref = (c[at], b[at].astype(np.uint32)), text[at]
    pairs_of = _dealt(pair, _deal, shards)
    at = np.flatnonzero(b != BEGIN)
    at = at[_order(b[at], a[at], c[at])]
    triple, triple_ref = (b[at], a[at], c[at]), text[at]
    triples_of = _dealt(triple, _home, hot, shards)
    at = np.flatnonzero(s.places < 0)
    at = at[np.argsort(s.hashes[at], kind="stable")]
    word, word_ref = (s.hashes[at],), s.word_text[at]
    words_of = _dealt(word, lambda hashes: _deal(_rare(hashes), shards))
    rows = []
    for k in sorted({batch % shards, *triples_of, *pairs_of, *words_of}):      # any shard will do for the sums
        (t, t_at), (p, p_at), (w, w_at) = (x.get(k, ([y[:0] for y in (*z, z[0].astype(np.uint32))], NONE)) for x, z in (
            (triples_of, triple), (pairs_of, pair), (words_of, word)))
        ref = np.concatenate([triple_ref[t_at], pair_ref[p_at], word_ref[w_at]]).astype(np.uint32)
        rows.append((batch, k, len(t[0]), len(ref), _pack_triples(*t), _pack(np.zeros(len(ref), np.uint8), ref),
                     len(p[0]), _pack(*p), len(w[0]), _pack(*w), to_bytes(own) if k == batch % shards else None))
    return _batch(rows, ASKED)


NONE = np.empty(0, np.int64)


def _dealt(columns: tuple[np.ndarray, ...], deal, *args) -> dict[int, tuple[list[np.ndarray], np.ndarray]]:
    """Sorted rows by shard: the distinct ones and how often each occurs, and the places of all. ``deal``
    takes the first column, or three."""
    new = _starts(*columns)
    many = _lengths(new, len(columns[0])).astype(np.uint32)
    found = [*(x[new] for x in columns), many]
    home = deal(*found[:3 if len(columns) == 3 else 1], *args)
    places = dict(_by_shard(np.repeat(home, many)))
    return {k: ([x[at] for x in found], places[k]) for k, at in _by_shard(home)}


def _batch(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)],
                                      [name for name, _ in kinds])


def _spread(starts: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """One value a run for all its rows."""
    return np.repeat(values, _lengths(starts, n))


class Level:
    """The children of a level, searched relative to their parent."""

    def __init__(self, levels: dict[str, np.ndarray], name: str):
        self.pointers, self.children = EliasFano.of(levels, f"{name}.pointers"), EliasFano.of(levels, f"{name}.children")

    def rows(self, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From, to and base of the children of each parent, which ascend; of -1, none."""
        low, high, base = np.zeros((3, len(parent)), np.int64)
        at = np.flatnonzero(parent >= 0)
        low[at], high[at] = self.pointers.get_near(parent[at]), self.pointers.get_near(parent[at] + 1)
        later = np.flatnonzero(low > 0)
        base[later] = self.children.get_near(low[later] - 1) + 1
        return low, high, base

    def places(self, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each child in the level and in its parent's row, or -1; in any order. A
        parent or a child of -1 has none. Each distinct question is searched for once, in order."""
        key = np.where((parent >= 0) & (child >= 0), (parent << 32) | child, -1)
        key, back = np.unique(key, return_inverse=True)
        at = _starts(key >> 32)
        low, high, base = (_spread(at, len(key), x) for x in self.rows(key[at] >> 32))
        out = np.full(len(key), -1, np.int64)
        asked = np.flatnonzero((key >= 0) & (low < high))
        out[asked] = self.children.place_near(low[asked], high[asked], base[asked] + (key[asked] & 0xFFFFFFFF))
        return out[back], np.where(out >= 0, out - low, -1)[back]


def _place(e: EliasFano, asked: np.ndarray) -> np.ndarray:
    """Place of each number in a whole sequence, or -1; in any order."""
    asked, back = np.unique(asked, return_inverse=True)
    out = np.full(len(asked), -1, np.int64)
    real = np.flatnonzero(asked >= 0)
    out[real] = e.place_near(np.zeros(len(real), np.int64), np.full(len(real), e.n), asked[real])
    return out[back]


class Shard:
    """A shard's trie, searched in its mapped levels."""

    def __init__(self, levels: dict[str, np.ndarray], hot: int):
        self.levels, self.hot = levels, hot
        self.symbols, self.heads = (EliasFano.of(levels, x) for x in ("symbols", "heads"))
        self.pairs, self.contexts, self.triples = (Level(levels, x) for x in ("pairs", "contexts", "triples"))

    def gains(self, b: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
        """What a shard's n-grams add to each triple; hot words' pairs add it
        elsewhere. Words and contexts are searched once a run of equal ones."""
        n = len(b)
        at, at_a = _starts(b), _starts(b, a)
        head = _spread(at, n, _place(self.heads, _place(self.symbols, b[at])))
        context = _spread(at_a, n, self.contexts.places(head[at_a], _place(self.symbols, a[at_a]))[0])
        pair, among = self.pairs.places(head, _place(self.symbols, c))
        triple, _ = self.triples.places(context, among)
        out = np.zeros(n)
        cold = (b >= self.hot) & (head >= 0)
        out[cold] = self.levels["left"][head[cold]]
        for place, name in ((np.where(cold, pair, -1), "pair"), (context, "weight"), (triple, "gain")):
            seen = place >= 0
            out[seen] += read_quantised(self.levels, name, place[seen])
        return out


class HotPairs:
    """The pairs of hot words that a shard has."""

    def __init__(self, levels: dict[str, np.ndarray]):
        self.levels, self.symbols, self.pairs = levels, EliasFano.of(levels, "symbols"), Level(levels, "pairs")

    def gains(self, c: np.ndarray, b: np.ndarray) -> np.ndarray:
        place, _ = self.pairs.places(_place(self.symbols, c), b)
        out = np.zeros(len(c))
        out[place >= 0] = read_quantised(self.levels, "pair", place[place >= 0])
        return out


def _answers(asked: pa.Table, held: pa.Table, hot: int) -> pa.Table:
    """What one shard answers: sums by text, a row for each batch that asks."""
    from zstandard import ZstdDecompressor
    unpack = ZstdDecompressor().decompress
    shard, hot_pairs, known_words, counts = None, None, np.empty(0, np.uint64), np.empty(0, np.int64)
    for levels, pairs, n, packed_words in zip(*(held[x] for x in ("levels", "pairs", "n", "words"))):
        if levels.is_valid:
            shard = Shard(mapped(unpack(levels.as_py())), hot)
        elif pairs.is_valid:
            hot_pairs = HotPairs(mapped(unpack(pairs.as_py())))
        elif n.as_py():
            known_words, counts = _unpack(packed_words.as_py(), n.as_py(), np.uint64, np.int64)
    rows = []
    for some in _several(asked):
        triples = [_unpack_triples(r["block"], r["n"], np.uint32) for r in some]
        gains = shard.gains(*(np.concatenate(x) for x in list(zip(*triples))[:3])) if shard else np.zeros(sum(r["n"] for r in some))
        pairs = [_unpack(r["pairs"], r["n_pairs"], np.int64, np.uint32, np.uint32) for r in some]
        c, b = (np.concatenate(x) for x in list(zip(*pairs))[:2])
        pair_gains = hot_pairs.gains(c, b.astype(np.int64)) if hot_pairs else np.zeros(len(c))
        low = low_p = 0
        for r, (*_, times), (*_, pair_times) in zip(some, triples, pairs):
            gain = np.append(np.repeat(gains[low:low + r["n"]], times), np.repeat(pair_gains[low_p:low_p + r["n_pairs"]], pair_times))
            low, low_p = low + r["n"], low_p + r["n_pairs"]
            w, word_times = _unpack(r["words"], r["n_words"], np.uint64, np.uint32)
            spot = _look(known_words, w)
            hit = spot >= 0
            count = np.where(hit, counts[spot] if len(counts) else 0, 0)
            _, ref = _unpack(r["places"], r["refs"], np.uint8, np.uint32)
            by_gain, by_word = ref[:len(gain)], ref[len(gain):]
            texts = np.flatnonzero(np.bincount(by_gain))
            texts_w = np.flatnonzero(np.bincount(by_word))
            rows.append((r["batch"], len(texts), _pack(texts.astype(np.uint32), np.bincount(by_gain, gain)[texts].astype(np.float32)),
                         len(texts_w), _pack(texts_w.astype(np.uint32),
                                             np.bincount(by_word, np.repeat(np.log10(count + ALPHA), word_times))[texts_w],
                                             np.bincount(by_word, np.repeat(hit, word_times))[texts_w].astype(np.uint32)), r["own"]))
    return pa.Table.from_batches([_batch(rows, ANSWERED)])


def _several(asked: pa.Table) -> Iterator[list[dict]]:
    """The rows of ``asked``, as many together as hold ASKS triples."""
    held, size = [], 0
    for r in zip(*(asked[name] for name, _ in ASKED)):
        held.append({name: x.as_py() for (name, _), x in zip(ASKED, r)})
        size += held[-1]["n"]
        if size >= ASKS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _together(table: pa.Table) -> pa.Table:
    """The texts of one batch with all their sums."""
    own = next(mapped(o.as_py()) for o in table["own"] if o.is_valid)
    base, score, known = (np.array(own[name]) for name in ("base", "score", "n_known"))
    # In a fixed order, so that reruns add up the same numbers alike.
    for i in np.lexsort((table["n_words"].to_numpy(), table["n"].to_numpy())).tolist():
        n, gains, n_words, logs = (table[name][i].as_py() for name in ("n", "gains", "n_words", "logs"))
        texts, gain = _unpack(gains, n, np.uint32, np.float32)
        score[texts] += gain
        texts, log, hits = _unpack(logs, n_words, np.uint32, np.float64, np.uint32)
        base[texts] += log
        score[texts] += log
        known[texts] += hits
    return pa.table({"key": np.array(own["key"]), "n_tokens": np.array(own["n_tokens"]), "n_known": known,
                     "base_score": base, "score": score})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """key, n_tokens, n_known, base_score and score of every row.

    Null text counts as empty: one token, the end. A null id counts as the
    smallest. Repeated rows each get their row. With nothing learned every token is as
    likely as any, score 0. An empty table gives no rows. Columns beside doc_id
    and text are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(doc_key().alias("key"), text_of().alias("text"))
    head = model.head

    def answers(asked: pa.Table, held: pa.Table) -> pa.Table:
        return _answers(asked, held, Head(mapped(head.value)).hot)

    answered = questions(rows, model).groupBy("shard").cogroup(model.levels.groupBy("shard")).applyInArrow(
        answers, "batch bigint, n int, gains binary, n_words int, logs binary, own binary")
    return answered.groupBy("batch").applyInArrow(
        _together, "key bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs.filter(~held_out(HELD_OUT, 0)))
    out = score(docs, model).withColumn("doc_id", from_key("key"))
    return out.select("doc_id", held_out(HELD_OUT, 0).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
