import random

import pytest
from brute import alignment, table
from pyspark.sql import functions as F

from tidemark.llm import alignment as al

NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted((r["key"], *(r[n] for n in NAMES)) for r in df.collect())


def corpus(n=60, seed=4):
    rng = random.Random(seed)
    words = ["the", "language", "Überraschung", "naïve", "日本語", "123456", "\t", "\n\n", "  ", "'s", "don't", "ﬁ", "😀", "é",
             "<|endoftext|>", "<s>", "▁", " ", "x" * 30, "0x1F", "\x00", " "]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 60])))) for i in range(n)]


@pytest.mark.parametrize("part, size", [(1 << 20, 8 << 20), (200, 700)])
def test_equals_brute_force(spark, monkeypatch, part, size):
    """Odd characters, special tokens' strings, leading and trailing space; with
    several parts a segment and several segments a task."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(al)      # the smaller sizes go to the workers
    monkeypatch.setattr(al, "PART", part)
    monkeypatch.setattr(al, "SEGMENT", size)
    try:
        rows = corpus() + [(100, " a b"), (101, "a b "), (102, "   "), (103, "a"), (104, "w " * 4000)]
        df = al.aligned(table(spark, rows).coalesce(3), with_groups=True)
        assert got(df) == alignment(rows)
        assert all(al.segments and (r.groups == "") == (r.n_a == 0) for r in df.collect())
    finally:
        cloudpickle.unregister_pickle_by_value(al)


def test_odd_rows(spark):
    """Null and repeated ids, null and empty texts, equal rows; an empty table."""
    rows = [(None, "a b"), (None, None), (5, ""), (6, "same text"), (6, "same text"), (-7, "same text here")]
    want = alignment([(-(2 ** 63) if d is None else d, t) for d, t in rows])
    assert got(al.aligned(table(spark, rows))) == want
    assert al.aligned(table(spark, [])).count() == 0
    assert got(al.aligned(table(spark, [(1, None), (2, "")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pair_counts(spark):
    """Counts over all documents, the highest of each B id with ties."""
    found = al.segments(table(spark, corpus()), *(open(p, m).read() for p, m in zip(al.default_paths(), ("r", "rb"))))
    counts = al.pair_counts(found)
    assert counts.agg(F.sum("count")).first()[0] == sum(r[4] for r in alignment(corpus()))
    top = counts.groupBy("b").agg(F.max("count").alias("m"), F.max(F.when(F.col("best"), F.col("count"))).alias("t"))
    assert top.where("m != t or t is null").count() == 0
