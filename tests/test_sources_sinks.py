"""Sources (Kafka decode, CSV/text, JDBC, catalog) and sinks (snapshots, day files)."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import new_dir, rows
from tidemark.sinks import files as file_sinks
from tidemark.sinks import snapshot
from tidemark.sources import catalog, files, jdbc, kafka


def test_kafka_decode_tolerant(spark):
    recs = spark.createDataFrame([
        (None, '{"a":1}', "t", 0, 1),          # null key: value and metadata kept
        ("{bad", '{"a":2}', "t", 0, 2),        # bad key: everything after is missing
        ('{"k":1}', "{bad", "t", 1, 3),        # bad value: metadata missing
        ('{"k":2}', '{"a":4}', "t", 1, 4),     # both good
    ], "key string, value string, topic string, partition int, offset bigint")
    recs = recs.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                       "topic", "partition", "offset", F.current_timestamp().alias("timestamp"))
    out = kafka.decode_key_value(recs).select(
        kafka.node_text(F.col("key"), "$.k").alias("k"),
        kafka.node_text(F.col("value"), "$.a").alias("a"),
        F.col("metadata.offset").alias("off"), "decode_ok").collect()
    assert [tuple(r) for r in out] == [(None, "1", 1, True), (None, None, None, False),
                                       ("1", None, None, False), ("2", "4", 4, True)]


def test_guarded_fields(spark):
    df = spark.createDataFrame([('{"id":"1","username":"u","password":"p"}',),
                                ('{"id":"1","password":"p"}',), ('{"username":"u"}',),
                                ("{bad",)], "v string")
    out = df.select(*kafka.guarded_fields(F.col("v"))).collect()
    assert [tuple(r) for r in out] == [("1", "u", "p"), ("1", "null", "null"),
                                       ("0", "null", "null"), ("0", "null", "null")]


def test_text_csv_sources(spark):
    d = new_dir()
    with open(os.path.join(d, "words.txt"), "w") as f:
        f.write("hello,world\nfoo bar\n\nbaz,\n")
    w = files.read_words(spark, d)
    assert [r.word for r in w.collect()] == ["hello", "foo bar", "baz"]  # CSV skips blank lines
    lines = files.read_lines(spark, d)
    assert lines.count() == 4
    s = new_dir()
    with open(os.path.join(s, "sensor.txt"), "w") as f:
        f.write("1,1000,12.3\n2,2000,22.0\n3, 3000 ,24.8\n4,x,1\n")
    got = rows(files.parse_sensor_line(files.read_lines(spark, s)))
    assert got == [("1", 1000, 12.3, True), ("2", 2000, 22.0, True), ("3", 3000, 24.8, True),
                   ("4", None, 1.0, False)]
    t = files.read_sensor_table(spark, s)
    assert t.where("valid").count() == 4 and "pt" in t.columns


def test_jdbc_split_options():
    """A query with a column and bounds is a derived table read in ranges; else one task reads it."""
    assert jdbc.query_options("select * from t") == {"query": "select * from t"}
    assert jdbc.query_options("select id, v from t;", "id", 0, 100, 4) == {
        "dbtable": "(select id, v from t) split_query", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
        "numPartitions": "4"}
    assert jdbc.split_options("id", 1, 9, None)["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.query_options("select * from t", "id")


def test_jdbc_roundtrip_derby(spark):
    url = "jdbc:derby:memory:tm_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([("1", 100, 12.5, "2021-01-25"), ("2", 200, 22.0, "2021-01-27")],
                               "id string, ts bigint, timepreture double, c_time string")
    types = "id VARCHAR(20), c_time VARCHAR(10)"
    jdbc.write_table(df, url, "sensor", props, mode="overwrite", column_types=types)
    src = jdbc.read_table(spark, url, "sensor", props).where(F.col("c_time") > "2021-01-26")
    assert [r.id for r in src.collect()] == ["2"]
    assert src.count() == 1
    # Spark created the columns with quoted lower-case names.
    js = jdbc.query_as_json(spark, url, 'select "id", "ts" from sensor order by "id"', n=5,
                            props=props)
    assert [r.json for r in js.collect()] == ['{"id":"1","ts":100}', '{"id":"2","ts":200}']
    jdbc.copy_table(spark, url, "select * from sensor", url, "sensor_copy", props, props,
                    column_types=types)
    assert jdbc.read_table(spark, url, "sensor_copy", props).count() == 2


def test_catalog_partition_scan(spark):
    d = new_dir()
    df = spark.range(30).select(F.col("id"), F.when(F.col("id") < 12, "2021-01-01")
                                .otherwise("2021-01-02").alias("dt"))
    df.write.mode("overwrite").partitionBy("dt").parquet(d)
    catalog.register_partitioned(spark, "tm_events_dt", d)
    part = catalog.scan_partition(spark, "tm_events_dt", "dt = '2021-01-01'")
    assert part.count() == 12
    assert catalog.scan_partition(spark, "tm_events_dt", "dt = '2021-01-01'", limit=10).count() == 10


def test_keep_max_snapshot_idempotent(spark):
    path = new_dir() + "/km"
    b0 = spark.createDataFrame([("r+1", 5), ("r+2", 3)], "row_key string, uv bigint")
    b1 = spark.createDataFrame([("r+1", 4), ("r+2", 7), ("r+3", 1)], "row_key string, uv bigint")
    snapshot.upsert_keep_max(b0, path, 0)
    snapshot.upsert_keep_max(b1, path, 1)
    snapshot.upsert_keep_max(b1.withColumn("uv", F.lit(100)), path, 1)  # replay: no-op
    snap = snapshot.read_snapshot(spark, path)
    assert rows(snap) == [("r+1", 5, "0"), ("r+2", 7, "0"), ("r+3", 1, "0")]
    cells = snapshot.point_read(snap, "row_key", "r+2")
    assert rows(cells) == [("r+2", "info", "max_online", "0"), ("r+2", "info", "uv", "7")]


def test_snapshot_survives_id_restart_and_two_writers(spark):
    """Ids that start again belong to a new writer; two writers share one table; only a replay is skipped."""
    path = new_dir() + "/shared"
    row = lambda k, v: spark.createDataFrame([(k, v)], "row_key string, uv bigint")
    snapshot.upsert_keep_max(row("a", 6), path, 5, writer="first")
    snapshot.upsert_keep_max(row("a", 100), path, 0, writer="second")     # a new checkpoint: batch 0
    snapshot.upsert_keep_max(row("a", 200), path, 5, writer="second")     # the other writer's id
    snapshot.upsert_keep_max(row("b", 1), path, 5, writer="first")        # its own last id: a replay
    assert rows(snapshot.read_snapshot(spark, path)) == [("a", 200, "0")]
    snapshot.upsert_keep_max(row("b", 1), path, 6, writer="first")
    assert rows(snapshot.read_snapshot(spark, path)) == [("a", 200, "0"), ("b", 1, "0")]
    assert snapshot.committed_versions(spark, path) == [1, 2, 3, 4]


def test_snapshot_loser_starts_over(spark, monkeypatch):
    """A commit number that another writer took meanwhile: the merge is done again."""
    path = new_dir() + "/race"
    row = lambda k, v: spark.createDataFrame([(k, v)], "row_key string, uv bigint")
    take, raced = snapshot._take, []

    def take_late(s, p, n, entry):
        if not raced:
            raced.append(n)
            snapshot.upsert_keep_max(row("other", 9), path, 0, writer="other")
        return take(s, p, n, entry)

    monkeypatch.setattr(snapshot, "_take", take_late)
    snapshot.upsert_keep_max(row("mine", 1), path, 0, writer="mine")
    assert rows(snapshot.read_snapshot(spark, path)) == [("mine", 1, "0"), ("other", 9, "0")]


def test_derived_table_follows_its_build(spark):
    from tidemark.sources import catalog
    df = spark.read.parquet("/root/testdata/sf0.001/nation.parquet").select("n_nationkey")
    one = catalog.derived_table(df.where("n_nationkey < 3"), "t", "parquet")
    assert catalog.derived_table(df.where("n_nationkey < 3"), "t", "parquet") == one
    two = catalog.derived_table(df, "t", "parquet")
    assert two != one and spark.read.parquet(two).count() == 25 and spark.read.parquet(one).count() == 3


def test_json_member_text(spark):
    from tidemark.sources import kafka
    cases = {'{"a":1,"a":2}': "2", '{"a":null}': "null", '{"a":1.0}': "1.0", '{"a":{"b":1}}': "", '{"a":"{x"}': "{x",
             '{"a":[1]}': "", '{"b":1}': None, '[1]': None, '{bad': None, '{"a":true}': "true", '{"a":""}': ""}
    df = spark.createDataFrame([(c, ) for c in cases], "v string")
    assert {r.v: r.t for r in df.select("v", kafka.node_text(F.col("v"), "$.a").alias("t")).collect()} == cases
    got = spark.createDataFrame([('{"id":"1","username":null,"password":"p"}', ), ('{"id":null}', )], "v string")
    assert rows(got.select(*kafka.guarded_fields(F.col("v")))) == [("1", "null", "p"), ("null", "null", "null")]


def test_last_write_snapshot(spark):
    path = new_dir() + "/lw"
    mk = lambda vals, t: spark.createDataFrame(
        [(d, m, v) for d, m, v in vals], "day string, metric string, value string") \
        .withColumn("u_time", F.lit(t).cast("timestamp"))
    snapshot.upsert_last_write(mk([("d1", "pv", "1"), ("d1", "uv", "1")], "2024-01-01 00:00:00"), path, 0)
    snapshot.upsert_last_write(mk([("d1", "pv", "5")], "2024-01-01 00:00:05"), path, 1)
    wide = snapshot.pivot_metrics(snapshot.read_snapshot(spark, path), "day", ["pv", "uv"], written_at=None)
    assert rows(wide) == [("d1", "5", "1")]


def test_day_bucket(spark):
    df = spark.createDataFrame([("1614527999000",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(file_sinks.day_bucket(F.col("t"))).collect()] == [
        "2021-02-28", "__invalid__", "__invalid__"]


@pytest.mark.parametrize("n", [3])
def test_json_day_files(spark, n):
    d = new_dir() + "/days"
    df = spark.createDataFrame([("a", 1614527999000), ("b", 1614528000000), ("c", 1614528000001)],
                               "event string, time bigint")
    recs = df.withColumn("dt", file_sinks.day_bucket(F.col("time").cast("string")))
    file_sinks.write_day_json(recs, d)
    assert sorted(x for x in os.listdir(d) if not x.startswith((".", "_"))) == [
        "dt=2021-02-28", "dt=2021-03-01"]
    assert spark.read.json(d).count() == n


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_lookup_enrich_cases(spark, broadcast):
    """FIXTURES §8: match; no match -> 0000; NULL phone stays NULL; missing id
    -> "0","null","null"; missing username -> id kept; duplicate dimension ids
    (first by order wins); by broadcast and by shuffle."""
    from tidemark.operators import joins
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    recs = spark.createDataFrame([
        ('{"id":"1","username":"a","password":"p"}',), ('{"id":"9","username":"b"}',),
        ('{"id":"2","username":"c"}',), ('{"username":"d"}',), ('{"id":"3"}',)], "v string")
    users = recs.select(*kafka.guarded_fields(F.col("v"))).drop("password")
    dim = spark.createDataFrame([("1", "111", 2), ("1", "999", 5), ("2", None, 1), ("3", "333", 1)],
                                "id string, phone string, ord int")
    out = joins.enrich_lookup(users, joins.dedup_dimension(dim, "id", "phone", "ord"), "id",
                              "phone")
    try:
        assert rows(out, "id", "username", "phone") == sorted([
            ("1", "a", "111"), ("9", "b", "0000"), ("2", "c", None), ("0", "null", "0000"),
            ("3", "null", "333")])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
