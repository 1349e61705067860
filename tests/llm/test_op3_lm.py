import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from brute import held, lm_base, lm_trigram, table

from tidemark.llm import lm
from tidemark.llm.common import held_out
from tidemark.llm.eliasfano import EliasFano, mapped, to_bytes


def corpus(seed=1, n=250):
    rng = random.Random(seed)
    words = "a b c dd E é f of the and".split()
    return ([(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(n)]
            + [(1000, None), (1001, ""), (1002, "the new words " * 5)])


@pytest.mark.parametrize("n,most", [(0, 1), (1, 1), (1000, 50), (3000, 2 ** 40), (70, 2 ** 62)])
def test_elias_fano(n, most):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, most, n))
    e = EliasFano.of(mapped(to_bytes(EliasFano.parts(v, "x"))), "x")
    assert (e.get(np.arange(n)) == v).all()
    if n:
        t = rng.integers(0, most, 100)
        assert (e.find(np.zeros(100, int), np.full(100, n), t) == np.searchsorted(v, t)).all()
        t = np.append(t, rng.choice(v, 100))
        low, high = np.sort(rng.integers(0, n + 1, (2, 200)), axis=0)
        want = [lo + np.searchsorted(v[lo:hi], x) for lo, hi, x in zip(low, high, t)]
        assert (e.find(low, high, t) == want).all()
        assert (e.place(low, high, t) == [w if w < hi and v[w] == x else -1 for w, hi, x in zip(want, high, t)]).all()


def run(df, **options):
    model = lm.train(df.filter(~held_out(10, 0)), **options)
    return model, {r.key: r for r in lm.score(df, model).collect()}


def test_base_and_model_match_brute_force(spark):
    rows = corpus()
    model, out = run(table(spark, rows), shard_tokens=500)     # several shards
    base, full = lm_base(rows), lm_trigram(rows)
    assert model.shards > 1 and set(out) == set(base)
    for d, (n, known, total, b) in base.items():
        assert (out[d].n_tokens, out[d].n_known, model.tokens) == (n, known, total)
        assert out[d].base_score == pytest.approx(b, abs=1e-9)
        assert out[d].score == pytest.approx(full[d], abs=0.02 * n)    # eight-bit probabilities


def test_words_no_task_has(spark, monkeypatch):
    """Words outside the tasks' table are answered by the join."""
    monkeypatch.setattr(lm, "KNOWN", 4)
    rows = corpus(2)
    _, out = run(table(spark, rows))
    for d, (_, known, _, b) in lm_base(rows).items():
        assert out[d].n_known == known and out[d].base_score == pytest.approx(b, abs=1e-9)


def test_repeated_rows_and_nothing_learned(spark):
    rows = corpus(3, 40)
    rows += [rows[1], rows[1], (1, "another text")]
    df = table(spark, rows)
    model = lm.train(df.filter(~held_out(10, 0)))
    out = lm.score(df, model)
    assert out.count() == len(rows)
    twin = [r.score for r in out.filter("key = 1").collect()]
    assert len(twin) == 4 and len({round(x, 9) for x in twin}) == 2
    empty = table(spark, [])
    model = lm.train(empty)
    assert model.tokens == 0 and lm.score(empty, model).count() == 0
    got = lm.score(table(spark, [(0, "some words"), (0, None)]), model).collect()
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 9)) for r in got) == [(1, 0, 0.0), (3, 0, 0.0)]


def test_held_out_text_scores_above_base(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _, out = run(df)
    test = [r for r in out.values() if held(r.key, 10, 0)]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


@pytest.mark.parametrize("known,shard_tokens", [(None, 4_000_000), (40, 4_000_000), (40, 3000), (None, 3000)])
def test_every_word_has_its_own_n_grams(spark, monkeypatch, known, shard_tokens):
    """More words than 4,093; rare ones with and without a number, hot ones spread over shards."""
    if known:
        monkeypatch.setattr(lm, "KNOWN", known)
    rng = random.Random(5)
    phrases = [" ".join(f"w{min(int(rng.paretovariate(0.6)), 10 ** 6)}" for _ in range(4)) for _ in range(1500)]
    phrases += [f"r{i} s{i} t{i}" for i in range(1500)]
    rows = [(i, " the ".join(rng.choice(phrases) for _ in range(rng.randint(0, 12)))) for i in range(500)]
    rows += [(1000 + i, p) for i, p in enumerate(phrases[1500:])]
    full, capped = lm_trigram(rows, 10 ** 9), lm_trigram(rows)
    _, out = run(table(spark, rows), shard_tokens=shard_tokens)
    for d, want in full.items():
        assert out[d].score == pytest.approx(want, abs=0.02 * out[d].n_tokens)
    assert sum(abs(capped[d] - full[d]) > 0.02 * out[d].n_tokens for d in full) > 500


@pytest.mark.parametrize("n,most", [(1, 1), (1000, 2000), (200_000, 2 ** 40), (300_000, 2 ** 20)])
def test_members_are_read_in_runs(n, most):
    rng = np.random.default_rng(n)
    v = np.unique(np.append(rng.integers(0, most, n), 2 ** 62 if most > 2 ** 30 else 0))
    n = len(v)
    e = EliasFano.of(mapped(to_bytes(EliasFano.parts(v, "x"))), "x")
    for lo, hi in [(0, n), (n // 3, n // 2), (n - 1, n), (n, n)]:
        assert (e.members(lo, hi) == v[lo:hi]).all()
    i = np.sort(rng.integers(0, n, 100_000))
    assert (e.get_near(i) == v[i]).all() and (e.get_near(i[::-1]) == v[i[::-1]]).all()
    t = np.sort(np.concatenate([rng.choice(v, 70_000), rng.integers(0, most + 5, 70_000)]))
    low, high = np.sort(rng.integers(0, n + 1, (2, len(t))), axis=0)
    at = np.searchsorted(v, t)
    want = np.where((at < n) & (v[np.minimum(at, n - 1)] == t) & (at >= low) & (at < high), at, -1)
    assert (e.place_near(low, high, t) == want).all() and (e.place(low, high, t) == want).all()
    few = t[::5000]
    assert (e.place_near(np.zeros(len(few), int), np.full(len(few), n), few) >= 0).tolist() == np.isin(few, v).tolist()


def test_batches_are_searched_together(spark, monkeypatch):
    """The questions of many batches are one search in a shard's trie, and it is read where it was written."""
    rows = corpus(6)
    df = table(spark, rows)
    model = lm.train(df, shard_tokens=500)
    plan = lm.score(df, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(shard") == 1
    held = model.levels.toArrow()
    vocabulary, head = lm.Vocabulary(mapped(model.vocabulary.value)), lm.Head(mapped(model.head.value))
    batches = []
    for i in range(3):
        texts = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i::3]]), pa.array([(r[1] or "").encode() for r in rows[i::3]])],
                                           ["key", "text"])
        for (keys,), s in lm._streams(iter([texts]), vocabulary, 1):
            batches.append(lm._asked(i, s, lm._known(s, vocabulary, head) | {"key": keys}, head.hot, model.shards))
    asked, calls = pa.Table.from_batches(batches), []
    gains = lm.Shard.gains
    monkeypatch.setattr(lm.Shard, "gains", lambda self, b, a, c: calls.append(len(b)) or gains(self, b, a, c))
    for k in range(model.shards):
        of = lm._answers(asked.filter(pc.equal(asked["shard"], k)), held.filter(pc.equal(held["shard"], k)), head.hot)
        alone = [lm._answers(asked.filter(pc.and_(pc.equal(asked["shard"], k), pc.equal(asked["batch"], i))),
                             held.filter(pc.equal(held["shard"], k)), head.hot) for i in range(3)]
        assert of.to_pylist() == [r for t in alone for r in t.to_pylist()]
        assert calls.pop(0) == sum(calls) and len(calls) <= 3
        calls.clear()
