"""Bucketed aggregates, and what Spark brings besides: windows, set operations, grouping sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.scalars import bucket_label
from tallyweave.operators import aggregates as A
from tallyweave.plans.base import Tables, register

QUERIES: dict = {}
ORACLES: dict = {}
query = register(QUERIES, ORACLES)

CENTS = "cast(round(value * 100) as bigint)"


def _cents():
    return F.round(F.col("value") * 100).cast("long")


def _bucket_query(bucket: str, table: str, ts: str, sql: str):
    def run(t: Tables):
        return getattr(t, table).groupBy(bucket_label(F.col(ts), bucket).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))

    run.__name__ = f"agg_{bucket}"
    query(f"select {sql} as bucket, count(*) as n from {table} group by 1")(run)


# months, quarters and the weeks around new year need orders; the rest use the finer times of events
for _bucket, _table, _ts, _sql in (
    ("secondly", "events", "ts", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
    ("minutely", "events", "ts", "strftime(ts, '%Y-%m-%d %H:%M')"),
    ("hourly", "events", "ts", "strftime(ts, '%Y-%m-%d %H')"),
    ("daily", "events", "ts", "strftime(ts, '%Y-%m-%d')"),
    ("weekly", "orders", "o_orderdate", "concat(year(o_orderdate), '-', weekofyear(o_orderdate))"),
    ("monthly", "orders", "o_orderdate", "strftime(o_orderdate, '%Y-%m')"),
    ("quarterly", "orders", "o_orderdate", "concat(year(o_orderdate), '-', quarter(o_orderdate))"),
    ("alltime", "events", "ts", "'all'"),
):
    _bucket_query(_bucket, _table, _ts, _sql)


_FIVE = f"sum({CENTS})::bigint as total, min({CENTS}) as least, max({CENTS}) as most, arg_min(event_type, struct_pack(a := ts, b := event_id)) as first_type, arg_max(event_type, struct_pack(a := ts, b := -event_id)) as last_type"


@query(f"select user_id, strftime(ts, '%Y-%m-%d') as bucket, {_FIVE} from events group by 1, 2")
def agg_measures(t: Tables):
    v, ts, seq = _cents(), F.col("ts"), F.col("event_id")
    return t.events.groupBy("user_id", bucket_label(ts, "daily").alias("bucket")).agg(A.total(v).alias("total"), A.least(v).alias("least"), A.most(v).alias("most"), A.first(F.col("event_type"), ts, seq).alias("first_type"), A.last(F.col("event_type"), ts, seq).alias("last_type"))


@query(f"select user_id, sum(case when event_type = 'error' then -{CENTS} else {CENTS} end)::bigint as total, min({CENTS}) filter (where event_type <> 'error') as least from events group by 1")
def agg_reversible_sum(t: Tables):
    old = F.col("event_type") == "error"
    return t.events.groupBy("user_id").agg(A.total(_cents(), old).alias("total"), A.least(_cents(), old).alias("least"))


@query("""with x as (select user_id, event_type, lag(event_type) over w as p, row_number() over w as n from events window w as (partition by user_id order by ts, event_id))
select user_id, sum(case when n > 1 and event_type is distinct from p then 1 else 0 end)::bigint as changes from x group by 1""")
def agg_count_changes(t: Tables):
    return A.count_changes(t.events, ["user_id"], "event_type", ["ts", "event_id"])


@query("""with x as (select user_id, event_type, count(*) as n from events group by 1, 2) select user_id, string_agg(event_type || '=' || n, ',' order by event_type) as types from x group by 1""")
def agg_by_key(t: Tables):
    rows = A.by_key(t.events, ["user_id"], "event_type", F.count(F.lit(1)), "m")
    return rows.select("user_id", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("types"))


@query("""select user_id, 'daily' as category, strftime(ts, '%Y-%m-%d') as bucket, count(*) as n from events group by all union all select user_id, 'alltime', 'all', count(*) from events group by all""")
def agg_many_buckets(t: Tables):
    return A.with_buckets(t.events, "ts", ["daily", "alltime", "daily"]).groupBy("user_id", "category", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("""with x as (select user_id as id, strftime(ts, '%Y-%m-%d') as bucket, count(*) as n from events group by 1, 2) select * from x where id = 7 and bucket between '2024-01-05' and '2024-01-20' order by bucket""")
def agg_query(t: Tables):
    rows = t.events.groupBy(F.col("user_id").alias("id"), bucket_label(F.col("ts"), "daily").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return A.query(rows, 7, "2024-01-05", "2024-01-20")


@query(f"""select user_id::varchar as id, strftime(ts, '%Y-%m-%d') as bucket, count(*) as count, sum({CENTS})::bigint as sum, min({CENTS}) as min, max({CENTS}) as max, arg_min({CENTS}, struct_pack(a := ts, b := event_id)) as first, arg_max({CENTS}, struct_pack(a := ts, b := -event_id)) as last from events group by 1, 2""")
def agg_merge_batches(t: Tables):
    """Two batches merged one after the other are the same as all rows at once."""
    rows = A.with_buckets(t.events.select(F.col("user_id").cast("string").alias("id"), "ts", "event_id", _cents().alias("v")), "ts", ["daily"])
    one, two = (A.partial(rows.where(c), "v", "ts", "event_id") for c in ("event_id % 3 <> 0", "event_id % 3 = 0"))
    return A.current(A.merged(one, two)).drop("category")


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_props(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("select strftime(time_bucket(interval '6 hours', ts, timestamp '2024-01-01'), '%Y-%m-%d %H:%M:%S') as start, count(*) as n from events group by 1")
def window_tumbling(t: Tables):
    return t.events.groupBy(F.window(F.col("ts").cast("timestamp"), "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("""with x as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '12 hours' then 0 else 1 end as s from events), y as (select user_id, sum(s) over (partition by user_id order by ts) as k from x)
select user_id, n, count(*) as sessions from (select user_id, k, count(*) as n from y group by 1, 2) group by 1, 2""")
def window_session(t: Tables):
    sessions = t.events.groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "12 hours")).agg(F.count(F.lit(1)).alias("n"))
    return sessions.groupBy("user_id", "n").agg(F.count(F.lit(1)).alias("sessions"))


@query("select c_custkey from customer where c_custkey in (select o_custkey from orders) and c_custkey not in (select user_id from events where user_id is not null)")
def set_operations(t: Tables):
    ids = lambda df, c: df.select(F.col(c).alias("c_custkey"))
    return ids(t.customer, "c_custkey").intersect(ids(t.orders, "o_custkey")).exceptAll(ids(t.events, "user_id").distinct())


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by rollup (o_orderstatus, o_orderpriority)")
def rollup_counts(t: Tables):
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
