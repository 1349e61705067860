import random

import numpy as np
from brute import near_components, table

from tidemark.llm import near_dedup as nd


def got(df):
    return {r.key: (f"{r.fp & (2 ** 64 - 1):016x}", r.component) for r in nd.near_duplicates(df).collect()}


def test_golay_lists():
    """Words within two bits share an index, and lists have one or six members."""
    tables = nd.golay_tables()
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    lists = nd.codeword_indices(words, *tables)
    assert set((lists >= 0).sum(axis=1)) <= {1, 6}
    for i in range(23):
        for j in range(23):
            other = nd.codeword_indices(words[:200] ^ (1 << i) ^ ((1 << j) if j != i else 0), *tables)
            assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(lists[:200], other))


def test_keys_meet_within_two_bits():
    tables, rng = nd.golay_tables(), np.random.default_rng(2)
    fps = rng.integers(-2 ** 63, 2 ** 63, 300)
    for _ in range(20):
        bits = rng.choice(64, 2, replace=False)
        near = (fps.view(np.uint64) ^ np.uint64(1 << int(bits[0])) ^ np.uint64(1 << int(bits[1]))).view(np.int64)
        a, b = (set(zip(*(x.tolist() for x in nd.golay_keys(f, *tables)))) for f in (fps, near))
        assert {i for i, _ in a & b} == set(range(300))


def corpus(seed=1):
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 300)}" for _ in range(400)] for _ in range(3)]
    rows = []
    for i in range(250):
        w = list(rng.choice(base)) if i % 2 else [f"v{rng.randint(0, 999)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            if w:
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 9)}"
        rows.append((i, " ".join(w).title() if i % 5 == 0 else "\n".join(w)))
    return rows


def test_matches_brute_force(spark, monkeypatch):
    rows = corpus() + [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "two words"), (905, " \t"), (906, "a b c " * 30000)]
    want = near_components(rows)
    assert len({c for _, c in want.values()}) < len(want) - 5
    assert got(table(spark, rows)) == want
    monkeypatch.setattr(nd, "PAIRS", 1)      # every bucket through the points
    assert got(table(spark, rows)) == want


def test_long_chain(spark):
    """Fingerprints two bits apart in a row are one component."""
    chain, x = [], 0
    for i in range(0, 60, 2):
        chain.append(x)
        x ^= 3 << i
    fps = spark.createDataFrame([(v, ) for v in chain] + [(0x5A5A5A << 38, )], "fp bigint")
    out = {r.node: r.root for r in nd.components(nd.links(fps)).collect()}
    assert out == {v: 0 for v in chain}


def test_edges(spark):
    assert nd.near_duplicates(table(spark, [])).count() == 0
    rows = [(2, "a b c d"), (2, "a b c d"), (1, "A B  c d"), (None, "other words here now"), (2, "other words here now")]
    out = nd.near_duplicates(table(spark, rows)).collect()
    assert len(out) == 5 and {r.component for r in out} == {1, -2 ** 63}
    kept = nd.one_of_each(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "other words here now"), (1, "A B  c d")]
