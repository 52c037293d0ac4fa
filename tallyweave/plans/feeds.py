"""Change feeds, domain objects, snapshots and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.scalars import entity_partition, lsn_next, lsn_number
from tallyweave.operators import changes as C
from tallyweave.operators import domain as D
from tallyweave.operators import entity as E
from tallyweave.plans.base import Tables, register

QUERIES: dict = {}
ORACLES: dict = {}
query = register(QUERIES, ORACLES)


@query("""with o as (select o_custkey, to_json(list(struct_pack(o_orderkey := o_orderkey, o_orderstatus := o_orderstatus) order by o_orderkey))::varchar as orders from orders group by 1)
select c_custkey, c_name, coalesce(o.orders, '[]') as orders from customer left join o on c_custkey = o_custkey""")
def domain_object(t: Tables):
    doc = D.has_many(t.customer.select("c_custkey", "c_name"), t.orders, "c_custkey", "o_custkey", "orders", ["o_orderkey", "o_orderstatus"], ["o_orderkey"])
    return doc.withColumn("orders", F.to_json("orders"))


@query("select c_custkey, to_json(struct_pack(n_nationkey := n_nationkey, n_name := n_name))::varchar as nation from customer join nation on c_nationkey = n_nationkey")
def domain_one_to_one(t: Tables):
    doc = D.has_one(t.customer, t.nation, "c_nationkey", "n_nationkey", "nation", ["n_nationkey", "n_name"])
    return doc.select("c_custkey", F.to_json("nation").alias("nation"))


@query("select c_custkey, to_json(struct_pack(name := n_name, region := n_regionkey))::varchar as nation from customer join nation on c_nationkey = n_nationkey")
def domain_prefix_nesting(t: Tables):
    flat = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("nation_name"), F.col("n_regionkey").alias("nation_region"))
    return D.nest(flat, ["nation"]).select("c_custkey", F.to_json("nation").alias("nation"))


@query("select c_custkey, c_name, false as _deleted from customer where c_custkey % 20 <> 0 union all select c_custkey, null, true from customer where c_custkey % 20 = 0")
def domain_tombstones(t: Tables):
    c = t.customer
    return D.objects(c, "c_custkey", c.where("c_custkey % 20 <> 0").select("c_custkey", "c_name"), [], tombstones=True)


@query("select distinct o_custkey as c_custkey from orders where o_orderkey in (select l_orderkey from lineitem)")
def translate_ids(t: Tables):
    order_ids = D.translate(t.lineitem, "l_partkey", ["l_orderkey"])
    return D.translate(order_ids, "l_orderkey", t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")))


@query("select floor(o_orderkey / 1000)::bigint as page, min(o_orderkey) as start, max(o_orderkey) as \"end\", count(*) as rows from orders group by 1")
def snapshot_pages(t: Tables):
    return D.snapshot_pages(t.orders, "o_orderkey", 1000)


_FEED = "select case when event_type = 'error' then 'delete' else 'update' end as op, 'app' as schema, event_type as \"table\", user_id as id, event_id, value from events"


def _feed(t: Tables):
    kind = F.when(F.col("event_type") == "error", "d").otherwise("write")
    return t.events.select(C.operation(kind).alias("op"), F.lit("app").alias("schema"), F.col("event_type").alias("table"), F.col("user_id").alias("id"), "event_id", "value", "event_type")


@query(f"with f as ({_FEED}) select op, schema, \"table\", to_json(list_sort(list(distinct id)))::varchar as ids from f group by 1, 2, 3")
def cdc_id_fold(t: Tables):
    return C.fold_ids(_feed(t), ["id"]).withColumn("ids", F.to_json("ids"))


@query("""with c as (select 'customer' as "table", (c_custkey % 50)::bigint as version, [c_custkey::varchar] as key, c_custkey as k from customer union all select 'orders', (o_orderkey % 50)::bigint, [o_orderkey::varchar], o_orderkey from orders)
select "table", version, array_to_string(key, ',') as key from c where version > 40 or (version = 40 and k > 300)""")
def cdc_change_tracking(t: Tables):
    tables = {"customer": (t.customer.withColumn("version", F.col("c_custkey") % 50), ["c_custkey"]), "orders": (t.orders.withColumn("version", F.col("o_orderkey") % 50), ["o_orderkey"])}
    return C.resume(tables, 40, (300,)).withColumn("key", F.array_join("key", ","))


@query(f"with f as ({_FEED}) select id, arg_max(op, event_id) as last_op, max(event_id) as last_seq, count(*) as n from f group by id")
def cdc_history(t: Tables):
    return C.history(_feed(t), "id", "op", "event_id")


@query(f"""with f as ({_FEED}), h as (select id, arg_max(op, event_id) as last_op, max(event_id) as last_seq from f group by id)
select h.id, last_op, last_seq, c_name, (last_op = 'delete' or c_custkey is null) as deleted from h left join customer on id = c_custkey""")
def cdc_enrich(t: Tables):
    return C.enrich(_feed(t), t.customer.select(F.col("c_custkey").alias("id"), "c_name"), "id", "op", "event_id")


@query("""select event_id, upper(hex(user_id)) || '/' || upper(hex(event_id)) as lsn, (user_id::hugeint * 4294967296 + event_id)::varchar as number, upper(hex(user_id)) || '/' || upper(hex(event_id + 1)) as next from events""")
def lsn_order(t: Tables):
    lsn = F.concat(F.hex("user_id"), F.lit("/"), F.hex("event_id"))
    return t.events.select("event_id", lsn.alias("lsn"), lsn_number(lsn).cast("decimal(38,0)").cast("string").alias("number"), lsn_next(lsn).alias("next"))


@query("""select event_id, 'public' as schema, 'events' as tbl, 'UPDATE' as op, '{"id":"' || event_id || '"}' as old, '{"id":"' || event_id || '","kind":"' || replace(event_type, 'e', chr(39)) || '","odd name":null}' as new from events""")
def wal_decode(t: Tables):
    """Text of the logical decoding plugin, made from the events and read back."""
    line = F.format_string("table public.events: UPDATE: old-key: id[bigint]:%d new-tuple: id[bigint]:%d kind[text]:'%s' \"odd name\"[character varying]:null", "event_id", "event_id", F.regexp_replace("event_type", "e", "''"))
    return C.decode(t.events.select("event_id", line.alias("value"))).select("event_id", "schema", "tbl", "op", F.to_json("old").alias("old"), F.to_json("new").alias("new"))


@query("""select c_custkey, 'customer-' || (abs(list_reduce(list_prepend(0::bigint, list_transform(string_split(c_custkey::varchar, ''), lambda ch: ascii(ch)::bigint)), lambda h, c: ((h * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648)) % 10)::varchar as partition from customer""")
def entity_partitions(t: Tables):
    return t.customer.select("c_custkey", entity_partition("customer", F.col("c_custkey")).alias("partition"))


@query("""with w as (select user_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events where user_id % 3 <> 0 group by 1)
select user_id, event_type, value from w union all select c_custkey, 'stored', 0.0::double from customer where c_custkey not in (select user_id from w)""")
def entity_upsert(t: Tables):
    stored = t.customer.select(F.col("c_custkey").alias("user_id"), F.lit("stored").alias("event_type"), F.lit(0.0).alias("value"))
    return E.upsert(stored, t.events.where("user_id % 3 <> 0").select("user_id", "event_type", "value", "event_id"), ["user_id"], "event_id")


@query("""with w as (select user_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) filter (where event_type = 'purchase') as value from events group by 1)
select coalesce(w.user_id, c_custkey) as user_id, c_name, event_type, value from customer full join w on w.user_id = c_custkey""")
def entity_merge(t: Tables):
    written = t.events.select("user_id", "event_type", F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"), "event_id")
    return E.merge(t.customer.select(F.col("c_custkey").alias("user_id"), "c_name"), written, ["user_id"], "event_id")


@query("select user_id, event_id, lag(event_type) over (partition by user_id order by event_id) as old_type, event_type as new_type from events")
def entity_old_new(t: Tables):
    return C.old_new(t.events, "user_id", "event_id", ["event_type"]).select("user_id", "event_id", F.col("old.event_type").alias("old_type"), F.col("new.event_type").alias("new_type"))
