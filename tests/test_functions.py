"""Golden tests of the scalar functions (FIXTURES.md §1, §9, §10)."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import (composite_key, java_split_space, json_map, local_text_from_ms,
                                project_event, project_properties, register_utc2local, text_hash,
                                utc2local)


def test_text_hash_golden(spark):
    df = spark.createDataFrame([("abc",), ("A1",), ("",), (None,), ("如何理解",)], "s string")
    got = {r.s: r.h for r in df.select("s", text_hash("s").alias("h")).collect()}
    assert got["abc"] == 1091 and got["A1"] == -1039 and got[""] == 0 and got[None] is None

    def java(s):
        h = 0
        for u in s.encode("utf-16-le").hex(" ", 2).split():
            cu = int.from_bytes(bytes.fromhex(u), "little")
            x = (h << 5) + cu - 96
            h = abs(x) % 11113 * (1 if x >= 0 else -1)
        return h
    assert got["如何理解"] == java("如何理解")


def test_text_hash_outside_bmp(spark):
    s = "a\U0001F600b"
    df = spark.createDataFrame([(s,)], "s string")
    h = 0
    for cu in [ord("a"), 0xD83D, 0xDE00, ord("b")]:
        x = (h << 5) + cu - 96
        h = abs(x) % 11113 * (1 if x >= 0 else -1)
    assert df.select(text_hash("s")).first()[0] == h


def test_utc2local_and_local_day(spark):
    df = spark.createDataFrame([(datetime(2021, 1, 1, 20, 0, 0),)], "t timestamp")
    assert df.select(F.date_format(utc2local("t"), "yyyy-MM-dd HH:mm:ss")).first()[0] == \
        "2021-01-02 04:00:00"
    register_utc2local(spark)
    df.createOrReplaceTempView("tm_t")
    assert spark.sql("select date_format(utc2local(t), 'HH') from tm_t").first()[0] == "04"
    ms = spark.createDataFrame([(1614527999000,), (1614528000000,)], "ms bigint")
    assert [r[0] for r in ms.select(local_text_from_ms("ms")).collect()] == ["2021-02-28", "2021-03-01"]


def test_json_map_rules(spark):
    df = spark.createDataFrame([
        ('{"event":"LiveVisit","properties":{"v1_message_id":null,"x":1},"time":1}',),
        ("not json",), ("",), ("[1,2]",), (None,),
        ('{"event":"$AppStart","distinct_id":"u1"}',)], "raw string")
    out = df.select("raw", *project_event("raw")).collect()
    first = out[0]
    assert first.event == "LiveVisit" and first.time == 1 and first.distinct_id == ""
    assert '"v1_message_id":null' in first.properties
    for r in out[1:5]:
        assert (r.event, r.distinct_id, r.properties, r.time) == ("", "", "", None)
    assert out[5].time is None
    p = df.limit(1).select(*project_properties(F.get_json_object("raw", "$.properties")))
    assert p.first().v1_message_id == "null"        # JSON null -> the text "null" (D6)
    assert p.first().v1_message_title == "null"     # missing -> default "null"
    m = spark.createDataFrame([('{"a":null}',)], "r string").select(json_map("r", False)["a"])
    assert m.first()[0] is None


def test_java_split(spark):
    df = spark.createDataFrame([("a b  c",), ("a b  ",), ("",), ("   ",), (" a",)], "l string")
    got = [r[0] for r in df.select(java_split_space("l")).collect()]
    assert got == [["a", "b", "", "c"], ["a", "b"], [""], [], ["", "a"]]


def test_composite_key_null(spark):
    df = spark.createDataFrame([("t", "1"), (None, "2")], "title string, id string")
    assert [r[0] for r in df.select(composite_key("title", "id")).collect()] == ["t+1", None]
