"""Batch queries over the driver tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import (json_map, may_contain_value, parse_events, parse_properties,
                                     to_json_object)
from tidemark.functions.text import composite_key, text_hash
from tidemark.functions.time import register_utc2local
from tidemark.operators import daily, guard, hot_items, joins, keyed, mergeable, rolling, windows, words
from tidemark.plans.registry import register
from tidemark.session import shared_dir
from tidemark.sinks import files as file_sinks
from tidemark.sinks import snapshot
from tidemark.sources import catalog, files, kafka
from tidemark.sources.tables import read_clickstream, read_table

# Event types of the driver table that stand in for the reference's events.
PV_EVENT = "view"     # the reference's "$AppStart"
LIVE_EVENT = "click"  # the reference's "LiveVisit"

LOCAL_DAY_SQL = "strftime(ts + interval 8 hour, '%Y-%m-%d')"


@register("daily_pv_uv", covers="W1 A6 A7 P4 P15", oracle=f"""
select {LOCAL_DAY_SQL} as day, count(*) as pv, count(distinct user_id) as uv
from events where event_type = '{PV_EVENT}' group by 1
""")
def q_daily_pv_uv(spark: SparkSession, sf_dir: str):
    return daily.daily_pv_uv(read_clickstream(spark, sf_dir), pv_event=PV_EVENT)


@register("daily_live", covers="W1 A8", oracle=f"""
select {LOCAL_DAY_SQL} as day, count(distinct user_id) as live_users,
       count(*) * cast(3.0 as double) / count(distinct user_id) / 60 as live_avg
from events where event_type = '{LIVE_EVENT}' group by 1
""")
def q_daily_live(spark: SparkSession, sf_dir: str):
    return daily.daily_live(read_clickstream(spark, sf_dir), live_event=LIVE_EVENT)


@register("daily_metrics", covers="W1 A6 A7 A8 A10", oracle=f"""
with a as (
  select {LOCAL_DAY_SQL} as day, event_type, count(*) as n, count(distinct user_id) as u
  from events where event_type in ('{PV_EVENT}', '{LIVE_EVENT}') group by all)
select day, 'pv' as metric, cast(n as varchar) as value from a where event_type = '{PV_EVENT}'
union all select day, 'uv', cast(u as varchar) from a where event_type = '{PV_EVENT}'
union all select day, 'live_avg', cast(n * cast(3.0 as double) / u / 60 as varchar)
  from a where event_type = '{LIVE_EVENT}'
union all select day, 'live_users', cast(u as varchar) from a where event_type = '{LIVE_EVENT}'
""")
def q_daily_metrics(spark: SparkSession, sf_dir: str):
    return daily.daily_metrics(read_clickstream(spark, sf_dir), pv_event=PV_EVENT,
                               live_event=LIVE_EVENT)


# --- hot items (W2 W7 A4 T1 T2) -------------------------------------------

HOT_ITEMS_SQL = """
with e as (
  select cast(json_extract_string(props, '$.k') as bigint) as item_id,
         ((epoch_us(ts) // 300000000) + 1 + i) * 300000 as window_end
  from events, range(12) t(i) where event_type = 'view'),
c as (select item_id, window_end, count(*) as view_count from e group by all),
r as (select *, row_number() over (partition by window_end order by view_count desc, item_id) as rank
      from c)
"""


@register("hot_items", covers="W2 W7 A4 T1", oracle=HOT_ITEMS_SQL + """
select item_id, window_end, view_count, cast(rank as integer) as rank from r where rank <= 3
""")
def q_hot_items(spark: SparkSession, sf_dir: str):
    return hot_items.hot_items(read_clickstream(spark, sf_dir), behavior=PV_EVENT)


@register("hot_items_report", covers="T1 T2", oracle=HOT_ITEMS_SQL + """
select window_end,
  repeat('=', 36) || chr(10) || '时间: ' ||
  strftime(make_timestamp(window_end * 1000) + interval 8 hour, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) ||
  string_agg('No' || (rank - 1) || ':' || '  商品ID=' || item_id || '  浏览量=' || view_count || chr(10),
             '' order by rank) ||
  repeat('=', 36) || chr(10) || chr(10) as report
from r where rank <= 3 group by window_end
""")
def q_hot_items_report(spark: SparkSession, sf_dir: str):
    top = hot_items.hot_items(read_clickstream(spark, sf_dir), behavior=PV_EVENT)
    return hot_items.report(top)


# --- rolling distinct counts (W4 W5 W6 A5 K3) --------------------------------

ROOM_PANES_SQL = """
with e as (select json_extract_string(props, '$.k') as message_id, user_id as u,
                  epoch_us(ts) // 10000000 as p from events)
"""


@register("rolling_uv", covers="W4 W6 A5", oracle="""
select event_type as event, s * 3600 as win_start, s * 3600 + 86400 as win_end,
       count(distinct user_id) as uv
from (select event_type, user_id, (epoch_us(ts) // 3600000000) - i as s
      from events, range(24) t(i)) group by all
""")
def q_rolling_uv(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir)
    seg = rolling.rolling_distinct_segments(ev, ["event"], "user_id", "time_us", 86400, 3600)
    return rolling.expand_segments(seg, ["event"], 86400, 3600)


@register("rolling_uv_segments", covers="W5 W6 A5 P7", oracle=ROOM_PANES_SQL + """,
c as (select distinct message_id, p - 8639 as q from e
      union select distinct message_id, p + 1 from e),
v as (select c.message_id, c.q, count(distinct e.u) as uv
      from c left join e on e.message_id = c.message_id and e.p between c.q and c.q + 8639
      group by all),
ch as (select *, lag(uv) over (partition by message_id order by q) as prev from v),
s as (select message_id, q, uv, lead(q) over (partition by message_id order by q) as nq
      from ch where prev is null or prev <> uv)
select message_id, 'room-' || message_id as title, q * 10 as seg_start, nq * 10 as seg_stop, uv
from s where uv > 0
""")
def q_rolling_uv_segments(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir).where(F.col("message_id").isNotNull())
    return rolling.rolling_distinct_segments(ev, ["message_id", "title"], "user_id", "time_us",
                                             86400, 10)


@register("peak_uv", covers="W5 A5 P14 K3", oracle=ROOM_PANES_SQL + """,
c as (select distinct message_id, p - 8639 as q from e),
v as (select c.message_id, c.q, count(distinct e.u) as uv
      from c join e on e.message_id = c.message_id and e.p between c.q and c.q + 8639
      group by all)
select 'room-' || message_id || '+' || message_id as row_key, max(uv) as uv, '0' as max_online
from v group by message_id
""")
def q_peak_uv(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir).where(F.col("message_id").isNotNull())
    seg = rolling.rolling_distinct_segments(ev, ["message_id", "title"], "user_id", "time_us",
                                            86400, 10)
    return snapshot.keep_max_rows(rolling.peak_distinct(seg, ["message_id", "title"]),
                                  composite_key("title", "message_id"), "uv")


# --- keyed windows, words, functions -------------------------------------------

@register("event_5s_count", covers="A9 W3 W8", oracle="""
select event_type as event, (epoch_us(ts) // 5000000 + 1) * 5000 as window_end, count(*) as n
from events group by all
""")
def q_event_5s_count(spark: SparkSession, sf_dir: str):
    return windows.keyed_window_count(read_clickstream(spark, sf_dir), ["event"], "5 seconds")


@register("word_count", covers="S9 P11 U3 A1", oracle="""
with l as (select unnest(string_split(text, chr(10))) as line from documents),
t as (select case when line = '' then ['']
                  when rtrim(line, ' ') = '' then []::varchar[]
                  else string_split(rtrim(line, ' '), ' ') end as ws from l)
select w as word, count(*) as n from (select unnest(ws) as w from t) group by w
""")
def q_word_count(spark: SparkSession, sf_dir: str):
    return words.word_count(read_table(spark, sf_dir, "documents"))


@register("utc2local", covers="F1 F2 U1", oracle="""
select event_id, epoch_us(ts) // 1000 + 28800000 as local_ms,
       strftime(ts + interval 8 hour, '%Y-%m-%d %H:%M:%S') as local_time,
       strftime(ts + interval 8 hour, '%Y-%m-%d') as local_date
from events
""")
def q_utc2local(spark: SparkSession, sf_dir: str):
    register_utc2local(spark)
    read_clickstream(spark, sf_dir).select("event_id", "ts", "time_ms") \
        .createOrReplaceTempView("tm_clicks")
    return spark.sql("""
        select event_id, time_ms + 28800000 as local_ms,
               date_format(utc2local(ts), 'yyyy-MM-dd HH:mm:ss') as local_time,
               date_format(utc2local(ts), 'yyyy-MM-dd') as local_date
        from tm_clicks""")


TEXT_HASH_SQL = ("list_reduce(list_transform(list_filter(string_split({c}, ''), lambda x: x <> ''), "
                 "lambda x: unicode(x)), lambda h, x: ((h * 32) + (x - 96)) % 11113, 0)")


@register("text_hash", covers="F4", oracle=f"""
select doc_id, {TEXT_HASH_SQL.format(c='text')} as bucket from documents
""")
def q_text_hash(spark: SparkSession, sf_dir: str):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", text_hash("text").alias("bucket"))


@register("bucket_distribution", covers="F4", oracle=f"""
select bucket, count(*) as n from (
  select {TEXT_HASH_SQL.format(c='p_name')} as bucket from part
  union all select {TEXT_HASH_SQL.format(c='n_name')} from nation
  union all select {TEXT_HASH_SQL.format(c='c_name')} from customer) group by bucket
""")
def q_bucket_distribution(spark: SparkSession, sf_dir: str):
    names = (read_table(spark, sf_dir, "part").select(F.col("p_name").alias("s"))
             .unionByName(read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("s")))
             .unionByName(read_table(spark, sf_dir, "customer").select(F.col("c_name").alias("s"))))
    return names.groupBy(text_hash("s").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@register("lookup_enrich", covers="J1 P12", oracle="""
select e.event_id, cast(e.user_id as varchar) as id, e.event_type as username,
       case when c.c_custkey is not null then c.c_name else '0000' end as phone
from events e left join customer c on c.c_custkey = e.user_id
""")
def q_lookup_enrich(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir).select(
        "event_id", F.col("distinct_id").alias("id"), F.col("event").alias("username"))
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("phone"), "c_custkey")
    dim = joins.dedup_dimension(cust, "id", "phone", "c_custkey")
    return joins.enrich_lookup(ev, dim, "id", "phone")


# --- keyed stateful functions, batch form (A2 A3 X9 X10 X12) -------------------

CENTS_SQL = "cast(round(value * 100) as bigint)"


def _cents(spark: SparkSession, sf_dir: str):
    return read_clickstream(spark, sf_dir).select(
        "event_id", "user_id", "event", "time_us",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"), "value")


@register("running_sum", covers="A2 A3", oracle=f"""
select event_id, user_id, row_number() over w as seq,
       cast(sum({CENTS_SQL}) over w as bigint) as running_cents
from events
window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)
""")
def q_running_sum(spark: SparkSession, sf_dir: str):
    r = keyed.running_totals(_cents(spark, sf_dir).select("event_id", "user_id", "time_us", "cents"),
                             ["user_id"], ["time_us", "event_id"], "cents")
    return r.select("event_id", "user_id", "seq", "running_cents")


@register("pair_average", covers="X9", oracle=f"""
with s as (select user_id, {CENTS_SQL} as c,
                  row_number() over (partition by user_id order by ts, event_id) as n from events),
g as (select user_id, (n - 1) // 2 as group_no, count(*) as k, sum(c) as sc from s group by all)
select user_id, group_no, cast(sc // 2 as bigint) as avg_value from g where k = 2
""")
def q_pair_average(spark: SparkSession, sf_dir: str):
    return keyed.pair_average(_cents(spark, sf_dir), ["user_id"], ["time_us", "event_id"], "cents")


@register("changelog_count", covers="X12", oracle="""
with s as (select event_type as event,
                  row_number() over (partition by event_type order by ts, event_id) as n from events)
select event, 2 * n - 1 as change_seq, true as is_add, n as cnt from s
union all select event, 2 * n - 2, false, n - 1 from s where n > 1
""")
def q_changelog_count(spark: SparkSession, sf_dir: str):
    return keyed.retract_changelog(_cents(spark, sf_dir), ["event"], ["time_us", "event_id"])


ALERT_TIMER_S = 3600  # the driver's events are minutes apart; 10 s would never fire


# A pending timer fires at the end if the input's event time reached it.
ALERT_SQL = f"""
with recursive s as (
  select user_id as k, epoch_us(ts) // 1000000 as t, value as v,
         row_number() over (partition by user_id order by ts, event_id) as n from events),
f(k, n, last, due, fired) as (
  select distinct k, cast(0 as bigint), cast(0.0 as double), cast(0 as bigint), cast(null as bigint) from s
  union all
  select s.k, s.n, s.v,
    case when s.v > f.last and (f.due = 0 or f.due <= s.t) then s.t + {ALERT_TIMER_S}
         when f.last > s.v or f.last = 0.0 then 0
         when f.due <= s.t then 0 else f.due end,
    case when f.due > 0 and f.due <= s.t then f.due end
  from f join s on s.k = f.k and s.n = f.n + 1),
last_state as (select k, due from f where n = (select max(n) from s where s.k = f.k)),
alerts as (
  select k, fired as fired_s from f where fired is not null
  union all select k, due from last_state where due > 0 and due <= (select max(t) from s))
"""


@register("rising_alert", covers="X10 U4", oracle=ALERT_SQL + """
select k as user_id, fired_s as fired_at, cast(k as varchar) || '温度连续上升' as alert from alerts
""")
def q_rising_alert(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir).select(
        "user_id", "event_id", "value",
        F.floor(F.col("time_us") / F.lit(1_000_000)).cast("bigint").alias("t"), "time_us")
    return keyed.rising_alerts(ev, "user_id", "t", ["time_us", "event_id"], "value",
                              timer_s=ALERT_TIMER_S)


# --- parsing and decoding (P1-P3 P9 P10 P13 S3 S4) -----------------------------

@register("clickstream_parse", covers="P1 P2 P3 P13 D6", oracle="""
select event_id, event_type as event, cast(user_id as varchar) as distinct_id,
       epoch_us(ts) // 1000 as time, json_extract_string(props, '$.k') as k,
       'null' as v1_message_id, 'null' as v1_element_content, 'null' as v1_message_title
from events
""")
def q_clickstream_parse(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir)
    raw = ev.select("event_id", to_json_object(
        "event", "distinct_id", F.parse_json("props").alias("properties"),
        F.col("time_ms").alias("time")).alias("raw"))
    parsed = parse_events(raw, "raw", keep=("event_id",))
    with_k = parsed.select("event_id", "event", "distinct_id", "time", "properties",
                           json_map("properties").getItem("k").alias("k"))
    return parse_properties(with_k, "properties",
                            keep=("event_id", "event", "distinct_id", "time", "k"))


def _kafka_records(spark: SparkSession, sf_dir: str):
    """Events as records; some have a malformed value (id mod 20 = 3) or key (5), a
    JSON null (7), a missing (9) or a repeated member (11)."""
    ev = read_clickstream(spark, sf_dir)
    m = F.pmod("event_id", F.lit(20))
    age = F.round(F.col("value") * 100).cast("bigint").cast("string")
    rest = F.concat(F.lit('"properties":{"userID":"'), "distinct_id", F.lit('"}}'))
    name = F.concat(F.lit('"event":"'), "event", F.lit('",'))
    value = (F.when(m == 3, F.lit("{bad"))
             .when(m == 7, F.concat(F.lit("{"), name, F.lit('"age":null,'), rest))
             .when(m == 9, F.concat(F.lit("{"), name, rest))
             .when(m == 11, F.concat(F.lit('{"event":"first",'), name, F.lit('"age":'), age, F.lit(","), rest))
             .otherwise(F.to_json(F.struct("event", age.alias("age"),
                                           F.struct(F.col("distinct_id").alias("userID")).alias("properties")))))
    key = F.when(m == 5, F.lit("{")).otherwise(F.to_json(F.struct(F.col("event_id").alias("id"))))
    return ev.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("events").alias("topic"),
                     F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))


@register("kafka_decode", covers="S3 S4 P9", oracle="""
select event_id % 20 not in (3, 5) as decode_ok,
       case when event_id % 20 not in (3, 5) then event_type end as event,
       case when event_id % 20 in (3, 5, 9) then null when event_id % 20 = 7 then 'null'
            else cast(cast(round(value * 100) as bigint) as varchar) end as age,
       case when event_id % 20 not in (3, 5) then cast(user_id as varchar) end as userID,
       case when event_id % 20 not in (3, 5) then event_id end as at,
       case when event_id % 20 not in (3, 5)
            then '消费的主题是：events,分区是：' || (user_id % 3) || ',当前偏移量是：' || event_id end as lineage
from events
""")
def q_kafka_decode(spark: SparkSession, sf_dir: str):
    dec = kafka.decode_key_value(_kafka_records(spark, sf_dir))
    return dec.select("decode_ok", kafka.node_text(F.col("value"), "$.event").alias("event"),
                      kafka.node_text(F.col("value"), "$.age").alias("age"),
                      kafka.node_text(F.col("value"), "$.properties.userID").alias("userID"),
                      F.col("metadata.offset").alias("at"), kafka.lineage().alias("lineage"))


@register("async_lookup", covers="S4 P10 P13 J1", oracle="""
with r as (select event_id, case when event_type <> 'signup' then cast(user_id as varchar)
                                 when event_id % 2 = 1 then 'null' end as rid,
                  event_type as uname from events),
g as (select event_id, coalesce(rid, '0') as id,
             case when rid is not null then uname else 'null' end as username from r),
j as (select g.event_id, g.id, g.username,
             case when c.c_custkey is not null then c.c_name else '0000' end as phone
      from g left join customer c on cast(c.c_custkey as varchar) = g.id)
select event_id, id, username, phone,
       to_json(struct_pack(id := id, username := username, phone := phone)) as json
from j
""")
def q_async_lookup(spark: SparkSession, sf_dir: str):
    """A signup has no id member, or, where the event id is odd, one that is JSON null."""
    ev = read_clickstream(spark, sf_dir)
    value = F.to_json(F.struct(
        F.when(F.col("event") != "signup", F.col("distinct_id")).alias("id"),
        F.col("event").alias("username"),
        F.when(F.col("event") == "purchase", F.lit("secret")).alias("password")))
    no_id = (F.col("event") == "signup") & (F.pmod("event_id", F.lit(2)) == 1)
    value = F.when(no_id, F.concat(F.lit('{"id":null,'), F.substring(value, F.lit(2), F.length(value)))).otherwise(value)
    rec = ev.select(F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value"),
                    F.lit("events").alias("topic"), F.lit(0).alias("partition"),
                    F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    dec = kafka.decode_key_value(rec)
    users = dec.select(F.col("metadata.offset").alias("event_id"),
                       *kafka.guarded_fields(F.col("value"))).drop("password")
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("phone"), "c_custkey")
    out = joins.enrich_lookup(users, joins.dedup_dimension(cust, "id", "phone", "c_custkey"),
                              "id", "phone")
    return out.select("event_id", "id", "username", "phone",
                      to_json_object("id", "username", "phone").alias("json"))


# --- guards (X1 D2 D3) --------------------------------------------------------------

GUARD_NOW_MS = 1705276800000  # 2024-01-15 00:00:00 UTC: later rows are "in the future"


@register("future_guard", covers="X1 D2 D3", oracle=f"""
with e as (select event_id, user_id % 3 as src, epoch_us(ts) // 1000 as t from events),
v as (select *, case when t - {GUARD_NOW_MS} <= 600000 then t end as vt from e)
select event_id,
       case when vt is not null then t
            else coalesce(cast(max(vt) over (partition by src order by event_id
                          rows between unbounded preceding and current row) as bigint), 0)
       end as guarded_time
from v
""")
def q_future_guard(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir).select(
        "event_id", "time_ms", F.pmod("user_id", F.lit(3)).alias("src"))
    g = guard.guard_future_clamp(ev, "time_ms", GUARD_NOW_MS, ["src"], ["event_id"])
    return g.select("event_id", "guarded_time")


# --- catalog, files, sinks (S6 S8 S9 S14 T3 K1 K4 P8) -------------------------------

@register("partition_scan", covers="S14", oracle="""
select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders where o_orderstatus = 'F'
""")
def q_partition_scan(spark: SparkSession, sf_dir: str):
    path = catalog.derived_table(read_table(spark, sf_dir, "orders"), "orders_by_status", "parquet", ["o_orderstatus"])
    catalog.register_partitioned(spark, "tm_orders_by_status", path)
    return catalog.scan_partition(spark, "tm_orders_by_status", "o_orderstatus = 'F'") \
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@register("day_files", covers="K1 F2 D7", oracle=f"""
select {LOCAL_DAY_SQL} as dt, count(*) as n, count(distinct user_id) as users from events group by 1
""")
def q_day_files(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir)
    recs = ev.select("event", "distinct_id", F.col("time_ms").alias("time"))
    recs = recs.withColumn("dt", file_sinks.day_bucket(F.col("time").cast("string")))
    path = shared_dir(spark, "day_files")
    file_sinks.write_day_json(recs, path)
    back = spark.read.schema("event STRING, distinct_id STRING, time BIGINT, dt STRING").json(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"),
                                  F.count_distinct("distinct_id").alias("users"))


@register("partition_limit", covers="S14 T3", oracle="""
select least(10, count(*)) as n, count(*) filter (o_orderstatus <> 'F') as others
from (select * from orders where o_orderstatus = 'F' limit 10)
""")
def q_partition_limit(spark: SparkSession, sf_dir: str):
    """LIMIT without order: which rows come is open, how many is not."""
    path = catalog.derived_table(read_table(spark, sf_dir, "orders"), "orders_by_status", "parquet", ["o_orderstatus"])
    catalog.register_partitioned(spark, "tm_orders_by_status", path)
    rows = catalog.scan_partition(spark, "tm_orders_by_status", "o_orderstatus = 'F'", limit=10)
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") != "F").alias("others"))


@register("metric_upsert", covers="K4 A10", oracle=f"""
with a as (
  select {LOCAL_DAY_SQL} as day, event_type, count(*) as n, count(distinct user_id) as u
  from events where event_type in ('{PV_EVENT}', '{LIVE_EVENT}') group by all)
select day,
  max(case when event_type = '{PV_EVENT}' then cast(n as varchar) end) as pv,
  max(case when event_type = '{PV_EVENT}' then cast(u as varchar) end) as uv,
  max(case when event_type = '{LIVE_EVENT}' then cast(n * cast(3.0 as double) / u / 60 as varchar) end)
    as live_avg,
  max(case when event_type = '{LIVE_EVENT}' then cast(u as varchar) end) as live_users
from a group by day
""")
def q_metric_upsert(spark: SparkSession, sf_dir: str):
    tall = daily.daily_metrics(read_clickstream(spark, sf_dir), pv_event=PV_EVENT,
                               live_event=LIVE_EVENT).withColumn("u_time", F.current_timestamp())
    path = shared_dir(spark, "daily_metrics_snapshot")
    pv = tall.where(F.col("metric").isin("pv", "uv"))
    snapshot.upsert_last_write(pv, path, 0)
    snapshot.upsert_last_write(tall.where(~F.col("metric").isin("pv", "uv")), path, 1)
    snapshot.upsert_last_write(pv, path, 1)  # replayed batch id: no-op
    wide = snapshot.pivot_metrics(snapshot.read_snapshot(spark, path), "day", list(daily.METRICS))
    return wide.drop("u_time")


@register("sensor_parse", covers="S9 P8 F3", oracle="""
select cast(user_id as varchar) as id, epoch_us(ts) // 1000000 as timestamp,
       case when event_id % 30 <> 4 then value end as temperature, event_id % 30 <> 4 as valid
from events
""")
def q_sensor_parse(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir)
    # Some lines hold no number where the temperature belongs.
    line = F.concat_ws(", ", F.col("distinct_id"),
                       F.floor(F.col("time_us") / F.lit(1_000_000)).cast("string"),
                       F.when(F.pmod("event_id", F.lit(30)) == 4, F.lit("n/a")).otherwise(F.col("value").cast("string")))
    path = catalog.derived_table(ev.select(line.alias("value")), "sensor_lines", "text")
    return files.parse_sensor_line(files.read_lines(spark, path))


@register("sensor_table", covers="S7", oracle="""
select case when event_id % 40 <> 6 then repeat('s', cast(event_id % 23 as integer)) || cast(user_id as varchar) end as id,
       epoch_us(ts) // 1000000 as timestamp, value as temperature,
       event_id % 40 <> 6 and event_id % 23 + length(cast(user_id as varchar)) <= 20 as valid, true as has_pt
from events
""")
def q_sensor_table(spark: SparkSession, sf_dir: str):
    """Ids of several lengths, some above 20 characters, some missing: flagged, not failed."""
    ev = read_clickstream(spark, sf_dir)
    name = F.concat(F.repeat(F.lit("s"), F.pmod("event_id", F.lit(23)).cast("int")), "distinct_id")
    rows = ev.select(F.when(F.pmod("event_id", F.lit(40)) != 6, name).alias("id"),
                     F.floor(F.col("time_us") / F.lit(1_000_000)).cast("bigint").alias("timestamp"),
                     F.col("value").alias("temperature"))
    t = files.read_sensor_table(spark, catalog.derived_table(rows, "sensor_table", "csv"))
    return t.select("id", "timestamp", "temperature", F.coalesce("valid", F.lit(False)).alias("valid"),
                    F.col("pt").isNotNull().alias("has_pt"))


@register("word_table", covers="S8", oracle="""
select p_name as word, count(*) as n from part group by 1
""")
def q_word_table(spark: SparkSession, sf_dir: str):
    """Lines "word,rest": the one declared column takes what stands before the first comma."""
    part = read_table(spark, sf_dir, "part")
    line = F.concat_ws(",", "p_name", F.col("p_partkey").cast("string"), F.lit("rest"))
    path = catalog.derived_table(part.select(line.alias("value")), "word_lines", "text")
    return files.read_words(spark, path).groupBy("word").agg(F.count("*").alias("n"))


@register("snapshot_point_read", covers="S15 K4 F5", oracle=f"""
with a as (
  select {LOCAL_DAY_SQL} as day, event_type, count(*) as n, count(distinct user_id) as u
  from events where event_type in ('{PV_EVENT}', '{LIVE_EVENT}') group by all),
m as (select max(day) as day from a),
c as (
  select day, 'pv' as qualifier, cast(n as varchar) as value from a where event_type = '{PV_EVENT}'
  union all select day, 'uv', cast(u as varchar) from a where event_type = '{PV_EVENT}'
  union all select day, 'live_avg', cast(n * cast(3.0 as double) / u / 60 as varchar) from a where event_type = '{LIVE_EVENT}'
  union all select day, 'live_users', cast(u as varchar) from a where event_type = '{LIVE_EVENT}')
select c.day as row_key, 'info' as family, q.qualifier, v.value, true as timed
from m join (select distinct day from c) c on c.day = m.day
cross join (values ('pv'), ('uv'), ('live_avg'), ('live_users')) q(qualifier)
left join c v on v.day = c.day and v.qualifier = q.qualifier
""")
def q_snapshot_point_read(spark: SparkSession, sf_dir: str):
    """The cells of the newest day's row; each row of the table carries the text of its write time."""
    tall = daily.daily_metrics(read_clickstream(spark, sf_dir), pv_event=PV_EVENT, live_event=LIVE_EVENT,
                               with_update_time=True)
    path = shared_dir(spark, "point-read")
    snapshot.upsert_last_write(tall.withColumn("u_time", F.col("update_time").cast("timestamp")), path, 0)
    held = snapshot.read_snapshot(spark, path)
    wide = snapshot.pivot_metrics(held, "day", list(daily.METRICS), written_at=None)
    newest = held.agg(F.max("day")).first()[0]
    timed = held.where(F.col("u_time").isNull()).isEmpty()
    return snapshot.point_read(wide, "day", newest).withColumn("timed", F.lit(timed))


@register("min_age_window", covers="A11", oracle="""
select (epoch_us(ts) // 3600000000) * 3600000 as window_start, event_type as event,
       arg_min(event_id, (cast(cast(round(value * 100) as bigint) as varchar), epoch_us(ts), event_id))
         as event_id,
       min(cast(cast(round(value * 100) as bigint) as varchar)) as age
from events group by all
""")
def q_min_age_window(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir).select(
        "ts", "event", "event_id", "time_us",
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("age"))
    best = windows.min_by_window(ev, ["event"], "age", "1 hour", ["time_us", "event_id"])
    return best.select("window_start", "event", "event_id", "age")


# --- rolling room peaks from raw JSON records (S5 P2-P7 W5 K3) ----------------

LIVE_CONTENT = "视频直播播放"   # fixed value: the content the room job keeps


def _raw_live_records(spark: SparkSession, sf_dir: str):
    """Raw JSON records in the reference's clickstream shape, derived from events:
    view events are 'LiveVisit'; content marks plays (value > 10)."""
    ev = read_clickstream(spark, sf_dir)
    props = F.struct(F.col("message_id").alias("v1_message_id"),
                     F.when(F.col("value") > 10, F.lit(LIVE_CONTENT)).otherwise(F.lit("其他"))
                     .alias("v1_element_content"),
                     F.col("title").alias("v1_message_title"),
                     F.col("distinct_id").alias("userID"))
    event = F.when(F.col("event") == PV_EVENT, F.lit("LiveVisit")).otherwise(F.col("event"))
    return ev.select(F.to_json(F.struct(event.alias("event"), "distinct_id",
                                        props.alias("properties"),
                                        F.col("time_ms").alias("time"))).alias("raw"))


@register("room_peak_from_json", covers="P1 P2 P3 P4 P5 W5 A5 P14 K3", oracle=f"""
with e as (select json_extract_string(props, '$.k') as message_id, user_id as u,
                  epoch_us(ts) // 10000000 as p
           from events where event_type = '{PV_EVENT}' and value > 10),
c as (select distinct message_id, p - 8639 as q from e),
v as (select c.message_id, c.q, count(distinct e.u) as uv
      from c join e on e.message_id = c.message_id and e.p between c.q and c.q + 8639
      group by all)
select 'room-' || message_id || '+' || message_id as row_key, max(uv) as uv, '0' as max_online
from v group by message_id
""")
def q_room_peak_from_json(spark: SparkSession, sf_dir: str):
    raw = _raw_live_records(spark, sf_dir)
    parsed = parse_events(raw.where(may_contain_value("raw", "LiveVisit")), "raw")
    live = parse_properties(parsed.where(F.col("event") == "LiveVisit"), "properties",
                            default="", keep=("distinct_id", "time"))
    kept = live.where((F.col("v1_element_content") == LIVE_CONTENT) &
                      (F.col("v1_message_id") != "") & (F.col("distinct_id") != ""))
    kept = kept.withColumn("time_us", F.col("time") * 1000)
    seg = rolling.rolling_distinct_segments(kept, ["v1_message_id", "v1_message_title"],
                                            "distinct_id", "time_us", 86400, 10)
    peaks = rolling.peak_distinct(seg, ["v1_message_id", "v1_message_title"])
    return snapshot.keep_max_rows(peaks, composite_key("v1_message_title", "v1_message_id"), "uv")


LIVE_VISIT_SCHEMA = ("event STRING, time BIGINT, "
                     "properties STRUCT<userID: STRING, v1_message_title: STRING, v1_message_id: STRING>")


@register("live_visit_sql", covers="S5 P6 P7 F1 U1", oracle=f"""
select json_extract_string(props, '$.k') as v1_message_id,
       'room-' || json_extract_string(props, '$.k') as v1_message_title,
       cast(user_id as varchar) as userID,
       strftime(ts + interval 8 hour, '%Y-%m-%d %H:%M:%S') as local_time
from events where event_type = '{PV_EVENT}'
""")
def q_live_visit_sql(spark: SparkSession, sf_dir: str):
    raw = _raw_live_records(spark, sf_dir)
    # A declared nested schema; members missing from a record become NULL.
    raw.select(F.from_json("raw", LIVE_VISIT_SCHEMA).alias("r")).select("r.*") \
        .createOrReplaceTempView("tm_live_visit")
    register_utc2local(spark)
    return spark.sql("""
        select properties.v1_message_id as v1_message_id,
               properties.v1_message_title as v1_message_title,
               properties.userID as userID,
               date_format(utc2local(timestamp_millis(time)), 'yyyy-MM-dd HH:mm:ss') as local_time
        from tm_live_visit
        where event = 'LiveVisit' and properties.v1_message_id is not null""")


@register("hot_items_csv", covers="S6 W2 T1", oracle=HOT_ITEMS_SQL + """
select item_id, window_end, view_count, cast(rank as integer) as rank from r where rank <= 3
""")
def q_hot_items_csv(spark: SparkSession, sf_dir: str):
    ev = read_clickstream(spark, sf_dir)
    behavior = (F.when(F.col("event") == PV_EVENT, "pv").when(F.col("event") == "purchase", "buy")
                .when(F.col("event") == "click", "cart").otherwise("fav"))
    rows = ev.select(F.col("user_id").alias("userId"), F.col("item_id").alias("itemId"),
                     (F.col("item_id") % 10).cast("int").alias("categoryId"),
                     behavior.alias("behavior"),
                     F.floor(F.col("time_us") / F.lit(1_000_000)).cast("bigint").alias("timestamp"))
    path = catalog.derived_table(rows, "user_behavior", "csv")
    ub = files.read_csv(spark, path, files.USER_BEHAVIOR)
    events = ub.select(F.col("behavior").alias("event"), F.col("itemId").alias("item_id"),
                       F.timestamp_seconds("timestamp").alias("ts"))
    return hot_items.hot_items(events, behavior="pv")


@register("rolling_uv_5s_segments", covers="W4 W6 A5", oracle="""
with e as (select json_extract_string(props, '$.k') as message_id, user_id as u,
                  epoch_us(ts) // 5000000 as p from events),
c as (select distinct message_id, p - 17279 as q from e
      union select distinct message_id, p + 1 from e),
v as (select c.message_id, c.q, count(distinct e.u) as uv
      from c left join e on e.message_id = c.message_id and e.p between c.q and c.q + 17279
      group by all),
ch as (select *, lag(uv) over (partition by message_id order by q) as prev from v),
s as (select message_id, q, uv, lead(q) over (partition by message_id order by q) as nq
      from ch where prev is null or prev <> uv)
select message_id, 'room-' || message_id as title, q * 5 as seg_start, nq * 5 as seg_stop, uv
from s where uv > 0
""")
def q_rolling_uv_5s_segments(spark: SparkSession, sf_dir: str):
    """HOP(time, 5 s, 1 day): 17,280 windows per event, never expanded."""
    ev = read_clickstream(spark, sf_dir).where(F.col("message_id").isNotNull())
    return rolling.rolling_distinct_segments(ev, ["message_id", "title"], "user_id", "time_us",
                                             86400, 5)


# --- user-defined mergeable aggregates (U2 A4) -----------------------------

@register("top_values", covers="U2 A4", oracle="""
with r as (select event_type as event, event_id as id, value,
                  row_number() over (partition by event_type order by value desc, event_id) as place
           from events where value is not null)
select event, cast(place as integer) as place, id, value from r where place <= 10
""")
def q_top_values(spark: SparkSession, sf_dir: str):
    """The ten rows of the largest value of each event type, by a user's own aggregate."""
    top = mergeable.mergeable_agg(read_clickstream(spark, sf_dir), ["event"], mergeable.TopK("value", "event_id", 10), "top")
    rows = top.select("event", F.posexplode("top").alias("at", "r"))
    return rows.select("event", (F.col("at") + 1).alias("place"), "r.id", F.col("r.weight").alias("value"))


@register("value_histogram", covers="U2 A4", oracle="""
with b as (select user_id, least(19, greatest(0, cast(floor(value / 25) as integer))) as bin
           from events where value is not null and not isnan(value))
select user_id, bin, count(*) as n from b group by all
""")
def q_value_histogram(spark: SparkSession, sf_dir: str):
    """A histogram of each user's values: bins of 25 from 0 on, what is beyond the ends in the outer ones."""
    found = mergeable.mergeable_agg(read_clickstream(spark, sf_dir), ["user_id"], mergeable.Histogram("value", 0.0, 25.0, 20), "bins")
    rows = found.select("user_id", F.posexplode("bins").alias("bin", "n"))
    return rows.where("n > 0")
