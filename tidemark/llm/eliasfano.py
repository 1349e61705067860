"""Elias-Fano sequences over NumPy arrays, and a file of named arrays to map.

A non-decreasing sequence of n numbers below U takes about 2 + log2(U / n) bits
a number: the low bits are packed, the high bits are a bit vector with a one
for each number and a zero for each step of the high part. A directory, made when
first asked, holds the ones before each 64 bits, about a bit a number. Members and
successors are read from these arrays as they are, no member is decoded beforehand. Questions
that nearly ascend are answered run by run: the members that a run spans are read
in one go, a bounded number, and none that no run spans.
"""

from __future__ import annotations

import json
import os
import tempfile
from functools import cache, cached_property

import numpy as np

ONE = np.uint64(1)
BYTES = np.uint64(0x0101010101010101)
TOPS = np.uint64(0x8080808080808080)
RUN = 1 << 16               # questions answered together
SPAN = 8                    # members read at once, at most, for each question of a run


@cache
def _places() -> np.ndarray:
    """Where the r-th one of a byte is, by byte * 8 + r."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.argsort(1 - bits, axis=1, kind="stable").astype(np.uint8).ravel()


def _nth(bits: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) of each 64-bit number."""
    s = bits - ((bits >> ONE) & np.uint64(0x5555555555555555))
    s = (s & np.uint64(0x3333333333333333)) + ((s >> np.uint64(2)) & np.uint64(0x3333333333333333))
    s = ((s + (s >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * BYTES        # ones up to each byte
    byte = np.bitwise_count(((r * BYTES | TOPS) - s) & TOPS).astype(np.uint64) << np.uint64(3)
    r = r - (((s << np.uint64(8)) >> byte) & np.uint64(255))
    return byte.astype(np.int64) + _places()[((((bits >> byte) & np.uint64(255)) << np.uint64(3)) + r).astype(np.int64)]


class EliasFano:
    """A read-only non-decreasing sequence: ``get`` reads any members, ``find`` successors."""

    def __init__(self, n: int, low_bits: int, last: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.last, self.low, self.high = n, low_bits, last, low, high

    @staticmethod
    def parts(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        """The arrays that make up the sequence, under names from ``name``."""
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        b = np.uint64(low_bits)
        place = (values >> b).astype(np.int64) + np.arange(n)
        high = np.zeros((int(place[-1]) >> 6) + 1 if n else 1, np.uint64)
        np.bitwise_or.at(high, place >> 6, ONE << (place & 63).astype(np.uint64))
        low = np.zeros((n * low_bits >> 6) + 2, np.uint64)
        if low_bits:
            part = values & ((ONE << b) - ONE)
            bit = np.arange(n, dtype=np.int64) * low_bits
            shift = (bit & 63).astype(np.uint64)
            np.bitwise_or.at(low, bit >> 6, part << shift)
            over = (bit & 63) + low_bits > 64
            np.bitwise_or.at(low, (bit[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
        last = int(values[-1] >> b) if n else -1
        return {f"{name}.shape": np.array([n, low_bits, last], np.int64), f"{name}.low": low, f"{name}.high": high}

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, low_bits, last = (int(x) for x in arrays[f"{name}.shape"])
        return cls(n, low_bits, last, arrays[f"{name}.low"], arrays[f"{name}.high"])

    @cached_property
    def ranks(self) -> np.ndarray:
        """The ones before each 64 high bits."""
        ones = np.bitwise_count(self.high)
        return np.cumsum(ones, dtype=np.uint32) - ones

    @cached_property
    def zero_ranks(self) -> np.ndarray:
        """The zeros before each 64 high bits."""
        return (np.arange(len(self.ranks), dtype=np.uint32) << np.uint32(6)) - self.ranks

    def get(self, i: np.ndarray) -> np.ndarray:
        """The members at ``i``."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ranks, i.astype(np.uint32), side="right") - 1
        place = (word << 6) + _nth(self.high[word], (i - self.ranks[word]).astype(np.uint64))
        return (place - i) << self.low_bits | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        bit = i * self.low_bits
        shift = (bit & 63).astype(np.uint64)
        got = self.low[bit >> 6] >> shift
        spill = np.where(shift > 0, self.low[(bit >> 6) + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((got | spill) & ((ONE << np.uint64(self.low_bits)) - ONE)).astype(np.int64)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many members have a high part below each of ``high``: the ones before its zero."""
        out = np.where(high > self.last, self.n, 0)
        inside = np.flatnonzero((high > 0) & (high <= self.last))
        zero = high[inside] - 1
        word = np.searchsorted(self.zero_ranks, zero.astype(np.uint32), side="right") - 1
        out[inside] = (word << 6) + _nth(~self.high[word], (zero - self.zero_ranks[word]).astype(np.uint64)) - zero
        return out

    def find(self, low: np.ndarray, high: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Place of the first member >= ``target`` in [low, high), ``high`` if none. The
        high part of ``target`` gives the members that share it; these are halved."""
        target = np.asarray(target, np.int64)
        part, rest = target >> self.low_bits, target & ((1 << self.low_bits) - 1)
        first = np.minimum(np.maximum(low, self._below(part)), high)
        last = np.maximum(np.minimum(high, self._below(part + 1)), first)
        open_ = np.flatnonzero(first < last)
        while len(open_):
            mid = (first[open_] + last[open_]) >> 1
            less = self._low(mid) < rest[open_]
            first[open_[less]] = mid[less] + 1
            last[open_[~less]] = mid[~less]
            open_ = open_[first[open_] < last[open_]]
        return first

    def place(self, low: np.ndarray, high: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Place of ``target`` in [low, high), or -1."""
        at = self.find(low, high, target)
        out = np.full(len(at), -1, np.int64)
        inside = np.flatnonzero(at < high)
        hit = inside[self.get(at[inside]) == target[inside]]
        out[hit] = at[hit]
        return out

    def members(self, start: int, stop: int) -> np.ndarray:
        """The members from ``start`` to ``stop``, read in one go."""
        if start >= stop:
            return np.empty(0, np.int64)
        first, last = np.searchsorted(self.ranks, np.array([start, stop - 1], np.uint32), side="right") - 1
        ones = np.flatnonzero(np.unpackbits(self.high[first:last + 1].view(np.uint8), bitorder="little").view(bool))
        skip = start - int(self.ranks[first])
        i = np.arange(start, stop)
        return (ones[skip:skip + stop - start] + (int(first) << 6) - i) << self.low_bits | self._low(i)

    def get_near(self, i: np.ndarray) -> np.ndarray:
        """``get`` for places that nearly ascend."""
        out = np.empty(len(i), np.int64)
        for at in range(0, len(i), RUN):
            run = i[at:at + RUN]
            start, stop = int(run.min()), int(run.max()) + 1
            out[at:at + RUN] = self.members(start, stop)[run - start] if stop - start <= SPAN * len(run) else self.get(run)
        return out

    def place_near(self, low: np.ndarray, high: np.ndarray, target: np.ndarray) -> np.ndarray:
        """``place`` for targets that nearly ascend, in a sequence without repeated numbers."""
        out = np.empty(len(target), np.int64)
        for at in range(0, len(target), RUN):
            lows, highs, run = (x[at:at + RUN] for x in (low, high, target))
            start, last = self.find(np.zeros(2, np.int64), np.full(2, self.n), np.array([run.min(), run.max()])).tolist()
            stop = min(last + 1, self.n)
            if stop - start > SPAN * len(run):
                out[at:at + RUN] = self.place(lows, highs, run)
                continue
            members = self.members(start, stop)
            spot = np.searchsorted(members, run)
            hit = np.append(members, -1)[spot] == run
            spot += start
            out[at:at + RUN] = np.where(hit & (spot >= lows) & (spot < highs), spot, -1)
        return out


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays in one block, each at a multiple of eight bytes."""
    heads, body, at = [], [], 0
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        heads.append([name, a.dtype.str, len(a), at])
        raw += bytes(-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    head = json.dumps(heads).encode()
    head += b" " * (-len(head) % 8)
    return len(head).to_bytes(8, "little") + head + b"".join(body)


def mapped(block: bytes) -> dict[str, np.ndarray]:
    """The arrays of :func:`to_bytes`, mapped from a file of the worker's own
    that has no name any more: it goes when the arrays do."""
    handle, path = tempfile.mkstemp(prefix="levels-")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(block)
        data = np.memmap(path, np.uint8, "r").view(np.ndarray)      # slices of a plain array cost less
    finally:
        os.unlink(path)
    n = int.from_bytes(bytes(data[:8]), "little")
    out = {}
    for name, kind, count, at in json.loads(bytes(data[8:8 + n])):
        start = 8 + n + at
        out[name] = data[start:start + count * np.dtype(kind).itemsize].view(kind)
    return out


def quantised(values: np.ndarray, name: str, levels: int = 256) -> dict[str, np.ndarray]:
    """Eight-bit codes and the mean of the values behind each code."""
    if not len(values):
        return {f"{name}.codes": np.empty(0, np.uint8), f"{name}.book": np.zeros(levels)}
    least, most = float(values.min()), float(values.max())
    width = (most - least) / levels or 1.0
    codes = np.minimum(((values - least) / width).astype(np.int64), levels - 1)
    n = np.bincount(codes, minlength=levels)
    middle = least + (np.arange(levels) + 0.5) * width
    book = np.where(n > 0, np.bincount(codes, values, levels) / np.maximum(n, 1), middle)
    return {f"{name}.codes": codes.astype(np.uint8), f"{name}.book": book}


def read_quantised(arrays: dict[str, np.ndarray], name: str, at: np.ndarray) -> np.ndarray:
    return arrays[f"{name}.book"][arrays[f"{name}.codes"][at]]
