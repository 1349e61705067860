import random
from collections import Counter

import pytest
from brute import mix_targets, table

from tidemark.llm.mixing import mix, mixed_documents

SCHEMA = "doc_id bigint, text string, source string"


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    hot = ["hot"] * 8 + ["é", "a", "B", None, "z", "😀", "tiny"]
    return [(i, "w " * rng.randint(0, 40 if i % 50 else 400), hot[0] if i % 3 == 0 else rng.choice(hot)) for i in range(n)]


@pytest.mark.parametrize("block", [128, 4])
def test_targets_and_rounding(spark, block):
    rows = corpus()
    out = mix(table(spark, rows, SCHEMA), block=block).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want, taken = mix_targets(sizes), Counter()
    for r in out:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        rate = want[r.source] / sizes[r.source]
        assert int(rate) <= r.copies <= int(rate) + 1 or r.size == 0
        taken[r.source] += r.taken
    for s in sizes:     # the last document decided is the only error
        assert abs(taken[s] - want[s]) <= max(len(t.split()) for _, t, x in rows if x == s)
    again = mix(table(spark, rows, SCHEMA).repartition(5), block=block).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in out}


def test_excess_is_shared_again(spark):
    rows = [(1, "w " * 1000, "a"), (2, "w " * 10, "b"), (3, "w " * 5, "c"), (4, "", "d")]
    out = {r.source: r for r in mix(table(spark, rows, SCHEMA)).collect()}
    want = mix_targets({"a": 1000, "b": 10, "c": 5, "d": 0})
    assert {s: round(r.target, 9) for s, r in out.items()} == {s: round(t, 9) for s, t in want.items()}
    assert out["b"].taken == 30 and out["c"].taken == 15 and out["d"].taken == 0


def test_chances_are_kept(spark):
    """Over seeds a document is taken as often as its source's rate says."""
    rows = [(i, "w " * (i % 7 + 1), "a" if i % 2 else "b") for i in range(120)]
    df = table(spark, rows, SCHEMA).cache()
    n, total = 5, Counter()
    for seed in range(n):
        out = mix(df, seed=seed, block=8).collect()
        for r in out:
            total[r.source] += r.copies
    rate = {r.source: r.target / r.source_size for r in out}
    for s, c in total.items():
        assert abs(c / (60 * n) - rate[s]) < 0.1


def test_edges(spark):
    assert mix(table(spark, [], SCHEMA)).count() == 0
    rows = [(None, None, None), (1, "", "a"), (2, "x y", None), (2, "x y", None), (2, "z", "a"), (3, "w " * 50000, "a")]
    out = mix(table(spark, rows, SCHEMA)).collect()
    assert len(out) == 6 and len({r.copies for r in out if r.size == 2}) == 1
    assert all(r.taken == 0 for r in mix(table(spark, rows[:2], SCHEMA)).collect())


def test_documents_of_the_mix(spark):
    rows = corpus(2, 200)
    df = table(spark, rows, SCHEMA)
    taken = Counter({r.doc_id: r.copies for r in mix(df).collect() if r.copies})
    out = mixed_documents(df)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == taken
