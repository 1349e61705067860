import random
import zlib

import numpy as np
import pytest
from brute import table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.bpe import default_path


def tokenizer():
    t = Tokenizer.from_file(default_path())
    t.no_truncation()
    t.no_padding()
    return t


def padding(lengths, capacity=1024):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths)


def checked(rows, pieces, capacity=1024):
    """Every id once, in its document's order; sequences without gaps. Returns the sequences' lengths."""
    t = tokenizer()
    want = sorted((d, [*t.encode(x or "", add_special_tokens=False).ids, 0]) for d, x in rows)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    got = []
    for d, ids in want:         # equal rows: each start as often as there are rows
        parts = by_doc[d, len(ids)]
        same = sum(1 for e, other in want if e == d and len(other) == len(ids))
        if same == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p.start):
                assert p.start == at and p.length > 0
                assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
                at += p.length
            assert at == len(ids)
        got.append(len(ids))
    assert sum(p.length for p in pieces) == sum(got)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    out = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        out.append(at)
    return out


def collected(df):
    return df.withColumnRenamed("key", "doc_id").collect()


def test_filling_is_the_closest():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1) if s + x * k <= room}
        taken = packing.best_filling(counts, room)
        assert all(n <= counts[x] for x, n in taken.items())
        assert sum(x * n for x, n in taken.items()) == max(sums)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 50), min_size=1, max_size=20), st.integers(0, 5))
def test_plan_places_every_piece(counts, slack):
    plan = packing.Plan(counts, 64, slack)
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    held, seen = {}, np.zeros(len(length), np.int64)
    for row, before, n, sequence, offset in plan.pieces(length, rank):
        assert (before == seen[row]).all()
        np.add.at(seen, row, n)
        for s, o, k in zip(sequence.tolist(), offset.tolist(), n.tolist()):
            held.setdefault(s, []).append((o, k))
    assert (seen == length).all() and set(held) == set(range(plan.sequences))
    totals = []
    for parts in held.values():
        at = 0
        for o, k in sorted(parts):
            assert o == at
            at += k
        totals.append(at)
    assert max(totals) <= 64 and sum(t < 64 - slack for t in totals) <= 1


def test_plan_follows_the_lengths_not_the_documents():
    """A thousand times the pieces: as many fillings but for a few."""
    rng = np.random.default_rng(5)
    counts = dict(zip(range(1, 1024), rng.integers(1, 50, 1023).tolist()))
    few, many = packing.Plan(counts), packing.Plan({x: n * 1000 + 7 for x, n in counts.items()})
    assert len(many.length) < 3 * len(few.length) + 20_000
    total = sum(x * (n * 1000 + 7) for x, n in counts.items())
    assert many.sequences * 1024 < total * 1.01


@pytest.mark.parametrize("hot", [False, True])
def test_pieces(spark, hot):
    """Long, short, empty and null texts; with a length that most documents have."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randint(0, 900)}" for _ in range(rng.choice([0, 3, 40, 200, 900])))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "é日本 <|endoftext|> " * 800), (-3, "a " * 1023), (-4, "a" * 5000)]
    if hot:
        rows += [(2000 + i, "the cat " * 350) for i in range(300)]
    pieces = collected(packing.packed_pieces(table(spark, rows)))
    lengths = checked(rows, pieces)
    assert padding(lengths) <= 1024 + packing.SLACK * len(lengths) and len(lengths) <= -(-sum(lengths) // 1016) + 1


def test_odd_rows(spark):
    """Null and repeated ids, equal rows; ids of pieces; an empty table."""
    rows = [(None, "a b c"), (None, None), (5, "x y"), (5, "x y"), (5, "z " * 3000)]
    pieces = collected(packing.packed_pieces(table(spark, rows), with_ids=True))
    rows = [(packing_null if d is None else d, t) for packing_null in [-(2 ** 63)] for d, t in rows]
    checked(rows, pieces)
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length for p in pieces)
    assert packing.packed_pieces(table(spark, [])).count() == 0
