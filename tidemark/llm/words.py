"""Words of whole texts as hashes, in NumPy, for many documents at once.

Texts are UTF-8 bytes joined by a space. A word's hash is a polynomial over
random numbers of its bytes, taken from running sums, so no loop runs over words;
a run of words is hashed the same way over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

PIECE = 1 << 18            # bytes hashed at once
MASK = (1 << 64) - 1

# Odd multipliers of the polynomials (bytes of a word, words of a
# run, words of a run again) and the seed of the bytes' numbers.
ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SEED = 20240229


@cache
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


@cache
def _numbers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, MASK, 256, np.uint64, endpoint=True)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, or those of its inverse."""
    key = (base, inverse)
    held = _POWERS.get(key)
    if held is None or len(held) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        factor = np.full(size, pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        factor[0] = 1
        held = np.multiply.accumulate(factor)
        if size <= PIECE * 2:
            _POWERS[key] = held
    return held[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~_space()[data]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = _sums(_numbers()[data], ODD[0])
    h = (sums[ends] - sums[starts]) * powers(ODD[0], len(data) + 1, True)[starts]
    return starts, ends, mixed(h + (ends - starts).astype(np.uint64))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every word of a byte buffer."""
    if len(data) <= PIECE:
        return _hash_piece(data)
    parts, at = [], 0
    while at < len(data):
        to = min(len(data), at + PIECE)
        while to < len(data) and not _space()[data[to - 1]]:   # cut after a space
            gaps = np.flatnonzero(_space()[data[to:to + PIECE]])
            to = to + int(gaps[0]) + 1 if len(gaps) else min(len(data), to + PIECE)
        s, e, h = _hash_piece(data[at:to])
        parts.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts))


def runs(hashes: np.ndarray, starts: np.ndarray, lengths, salt: int = 1) -> np.ndarray:
    """Hash of the ``lengths`` words from each of ``starts`` on."""
    sums = _sums(hashes, ODD[salt])
    h = (sums[starts + lengths] - sums[starts]) * powers(ODD[salt], len(hashes) + 1, True)[starts]
    return mixed(h)


def joined(texts: list[bytes | None], most: int = PIECE) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """(number of the first, texts, their joined bytes, offset of each text), about ``most`` bytes a time."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or b"")
        size += len(held[-1]) + 1
        if size >= most:
            yield first, held, *_buffer(held)
            first, held, size = i + 1, [], 0
    if held:
        yield first, held, *_buffer(held)


def _buffer(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in held], out=offsets[1:])
    return np.frombuffer(b" ".join(held), np.uint8), offsets
