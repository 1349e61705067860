"""Bucketed snapshots, pinned lookups, mergeable aggregates."""

import os
import random
import threading

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, new_dir, rows
from tidemark.operators import mergeable
from tidemark.sinks import bucketed, snapshot
from tidemark.streaming import lookup
from tidemark.streaming.runner import run_foreach_batch


def _rows(spark, pairs):
    return spark.createDataFrame(pairs, "row_key string, uv bigint")


def _folders(path):
    return {f"{d}/{b}" for d in os.listdir(path) if d.startswith("data-") for b in os.listdir(f"{path}/{d}") if b.startswith("_bucket")}


def _own(spark, keys, n):
    """Keys by their bucket."""
    found = {}
    for k, b in spark.createDataFrame([(k,) for k in keys], "k string").select("k", bucketed.bucket_of("k", n)).collect():
        found.setdefault(b, []).append(k)
    return found


def test_only_changed_buckets_are_rewritten(spark):
    path = new_dir() + "/t"
    keys = [f"room{i}" for i in range(200)]
    first = bucketed.upsert_keep_max(_rows(spark, [(k, 5) for k in keys]), path, 0, buckets=16)
    assert first == list(range(16)) or sorted(map(int, first)) == list(range(16))
    before = _folders(path)
    by_bucket = _own(spark, keys, 16)
    b = sorted(by_bucket)[3]
    low = sorted(by_bucket)[5]
    # One bucket rises; the other one is met but no value in it is larger.
    assert bucketed.upsert_keep_max(_rows(spark, [(by_bucket[b][0], 9), (by_bucket[low][0], 4)]), path, 1) == [b]
    assert len(_folders(path) - before) == 1
    assert bucketed.upsert_keep_max(_rows(spark, [(by_bucket[low][0], 5)]), path, 2) == []
    assert bucketed.upsert_keep_max(_rows(spark, [(by_bucket[b][0], 99)]), path, 2) == []       # a repeated batch
    want = sorted((k, 9 if k == by_bucket[b][0] else 5, "0") for k in keys)
    assert rows(bucketed.read_table(spark, path), "row_key", "uv", "max_online") == want
    assert rows(bucketed.read_key(spark, path, "row_key", by_bucket[b][0]), "uv") == [(9,)]
    assert bucketed.read_key(spark, path, "row_key", "none").count() == 0
    assert bucketed.read_table(spark, new_dir() + "/x") is None


def test_two_writers(spark, monkeypatch):
    """A writer that comes second keeps its folders if the other one met other buckets, and merges
    anew if they met: no row is lost."""
    path = new_dir() + "/t"
    keys = [f"k{i}" for i in range(64)]
    bucketed.upsert_keep_max(_rows(spark, [(k, 1) for k in keys]), path, 0, buckets=8, writer="w")
    by_bucket = _own(spark, keys, 8)
    (a, *_), (b, *_) = [by_bucket[x] for x in sorted(by_bucket)[:2]]
    merged, take, raced = [], snapshot._take, []
    inner = bucketed._merged
    monkeypatch.setattr(bucketed, "_merged", lambda *x: merged.append(x) or inner(*x))

    def second(key):
        def run(*x):
            if not raced:
                raced.append(1)
                bucketed.upsert_keep_max(_rows(spark, [(key, 7)]), path, 0, writer=f"other-{key}")
            return take(*x)
        return run

    monkeypatch.setattr(snapshot, "_take", second(b))
    assert len(bucketed.upsert_keep_max(_rows(spark, [(a, 5)]), path, 1, writer="mine")) == 1
    assert len(merged) == 2                                # each merged once
    raced.clear()
    merged.clear()
    monkeypatch.setattr(snapshot, "_take", second(a))
    bucketed.upsert_keep_max(_rows(spark, [(a, 6)]), path, 2, writer="mine")
    assert len(merged) == 3                                # met in a bucket: merged again
    got = dict(rows(bucketed.read_table(spark, path), "row_key", "uv"))
    assert got == {k: 7 if k in (a, b) else 1 for k in keys}


def test_many_writers_at_once(spark):
    path = new_dir() + "/t"
    bucketed.upsert_keep_max(_rows(spark, [("k0", 0)]), path, 0, buckets=8, writer="first")
    errors = []

    def run(w):
        try:
            for i in range(2):
                bucketed.upsert_keep_max(_rows(spark, [(f"k{j}", 10 * i + w) for j in range(w, 40, 2)]), path, i, writer=f"w{w}")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(w,)) for w in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    want = {f"k{j}": max(10 + w for w in range(4) if j >= w and (j - w) % 2 == 0) for j in range(40)}
    assert dict(rows(bucketed.read_table(spark, path), "row_key", "uv")) == want


def test_replaced_folders_go_after_a_while(spark, monkeypatch):
    path = new_dir() + "/t"
    bucketed.upsert_keep_max(_rows(spark, [("a", 1), ("b", 1)]), path, 0, buckets=4)
    bucketed.upsert_keep_max(_rows(spark, [("a", 2)]), path, 1)
    assert len(_folders(path)) >= 2
    monkeypatch.setattr(snapshot, "KEEP_SECONDS", -10)
    bucketed.upsert_keep_max(_rows(spark, [("a", 3)]), path, 2)
    assert rows(bucketed.read_table(spark, path), "row_key", "uv") == [("a", 3), ("b", 1)]
    assert len(snapshot.committed_versions(spark, path)) == 1


def test_changes_in_any_order(spark):
    path = new_dir() + "/t"
    mk = lambda r: spark.createDataFrame(r, "key string, is_add boolean, cnt bigint")
    bucketed.apply_changes(mk([("a", True, 1), ("a", False, 1), ("a", True, 2), ("b", True, 1), (None, True, 4)]), path, 0, buckets=4)
    bucketed.apply_changes(mk([("a", True, 3), ("a", False, 2), ("b", False, 1)]), path, 1)
    got = {(r.key, r.cnt) for r in bucketed.read_table(spark, path).collect()}
    assert got == {("a", 3), (None, 4)}
    bucketed.apply_changes(mk([("a", False, 3), (None, False, 4)]), path, 2)     # the last rows go
    assert bucketed.read_table(spark, path) is None
    bucketed.apply_changes(mk([("a", True, 1)]), path, 3)
    assert rows(bucketed.read_table(spark, path), "key", "cnt") == [("a", 1)]


def test_lookup_pins_the_version_of_a_batch(spark):
    """A batch that fails after its dimension was read joins the same version when it runs again,
    though another one has been published; the next batch sees the new one."""
    base = new_dir()
    dim = lambda v: spark.createDataFrame([("1", f"p{v}", 0), ("1", "second", 1), ("2", None, 0)], "id string, phone string, place int")
    lookup.publish(dim(1), f"{base}/dim")
    spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "id string").coalesce(1).write.parquet(f"{base}/in")
    sink = lookup.lookup_sink(f"{base}/dim", f"{base}/out", "id", "phone", "place")
    failed = []

    def fails_once(batch, batch_id):
        sink(batch, batch_id)
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    def run(fn):
        s = spark.readStream.schema("id string").parquet(f"{base}/in")
        run_foreach_batch(s, fn, "append", checkpoint=f"{base}/ck")

    with pytest.raises(Exception, match="lost"):
        run(fails_once)
    lookup.publish(dim(2), f"{base}/dim")
    run(fails_once)
    want = [("1", "p1"), ("2", None), ("3", "0000"), (None, "0000")]
    got = lambda: sorted(map(tuple, lookup.read_looked_up(spark, f"{base}/out").select("id", "phone").collect()), key=str)
    assert got() == sorted(want, key=str)
    spark.createDataFrame([("1",)], "id string").write.mode("append").parquet(f"{base}/in")
    run(sink)
    assert got() == sorted([*want, ("1", "p2")], key=str)


def _hot(spark):
    """One key holds a third of the rows."""
    return spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 31 != 0, F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        F.when(F.col("id") % 7 != 0, F.pmod(F.col("id") * 7919, F.lit(1009)).cast("double")).alias("v")).repartition(24)


@pytest.mark.parametrize("fanin, levels, held", [(64, 2, 100_000), (4, 3, 5)])
def test_mergeable_aggregates(spark, fanin, levels, held):
    df = _hot(spark).cache()
    own = lambda agg: {r.k: r.result for r in mergeable.mergeable_agg(df, ["k"], agg, fanin=fanin, levels=levels, held=held).collect()}
    assert own(mergeable.Count()) == {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    data = {}
    for r in df.collect():
        data.setdefault(r.k, []).append((r.v, r.id))
    top = {k: [(r.weight, r.id) for r in v] for k, v in own(mergeable.TopK("v", "id", 5)).items()}
    assert top == {k: sorted(((v, i) for v, i in x if v is not None), key=lambda r: (-r[0], r[1]))[:5] for k, x in data.items()}
    bins = own(mergeable.Histogram("v", 100.0, 50.0, 12))
    want = {}
    for k, x in data.items():
        want[k] = [0] * 12
        for v, _ in x:
            if v is not None:
                want[k][min(11, max(0, int((v - 100) // 50)))] += 1
    assert bins == want


def test_own_mergeable_aggregate(spark):
    """A user's own aggregate: distinct users as sets, over no rows too."""
    class Users:
        inputs, output = ("user_id",), "bigint"

        def create(self):
            return set()

        def add(self, acc, columns):
            return acc | set(columns[0].to_pylist())

        def merge(self, acc, other):
            return acc | other

        def result(self, acc):
            return len(acc)

    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = mergeable.mergeable_agg(ev, ["event_type"], Users(), "uv")
    assert rows(got) == rows(ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("uv")))
    assert mergeable.mergeable_agg(ev.limit(0), ["event_type"], Users(), "uv").count() == 0
    assert isinstance(pa.array([1]), pa.Array)


def test_no_group_gathers_a_hot_keys_accumulators(spark):
    """The first level merges at most ``fanin`` tasks' accumulators of a key in one group."""
    seen = spark.sparkContext.accumulator(0)

    class Widest(mergeable.Count):
        def merge(self, acc, other):
            seen.add(1)
            return acc + other

    df = spark.range(0, 4_000, 1, 40).select(F.lit("hot").alias("k"))
    out = mergeable.mergeable_agg(df, ["k"], Widest(), fanin=8, levels=2).collect()
    assert out[0].result == 4_000 and seen.value == 39        # 40 tasks: 35 merges in 5 groups, then 4 in one
