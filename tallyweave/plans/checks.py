"""Checksum and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.predicates import where_tree
from tallyweave.operators import reconcile as R
from tallyweave.plans.base import Tables, register
from tallyweave.sources.adapters import TableAdapter

QUERIES: dict = {}
ORACLES: dict = {}
query = register(QUERIES, ORACLES)

FIELDS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _hash_sql(price: str = "o_totalprice") -> str:
    parts = ["o_custkey::varchar", "o_orderstatus", f"({price})::decimal(38,2)::varchar", "floor(epoch(o_orderdate))::bigint::varchar", "o_orderpriority"]
    return "md5(" + " || ".join(f"coalesce(md5({p}), ' ')" for p in parts) + ")"


def _sums_sql(h: str = "h") -> str:
    return ", ".join(f"sum(cast('0x' || substr({h}, {1 + 8 * k}, 8) as bigint))::bigint as sum{k + 1}" for k in range(4))


def _longs(df):
    return df.select(*[F.col(c).cast("long") if c.startswith("sum") else F.col(c) for c in df.columns])


def _sides(t: Tables):
    o = t.orders
    slave = o.where("o_orderkey % 19 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return o.where("o_orderkey % 17 <> 0"), slave


_SIDES = f"""with m as (select o_orderkey as id, {_hash_sql()} as h from orders where o_orderkey % 17 <> 0),
s as (select o_orderkey as id, {_hash_sql("case when o_orderkey % 13 = 0 then o_totalprice + 1 else o_totalprice end")} as h from orders where o_orderkey % 19 <> 0),
d as (select coalesce(m.id, s.id) as id, case when s.id is null then 'missing' when m.id is null then 'extra' when m.h = s.h then 'correct' else 'incorrect' end as status from m full join s on m.id = s.id)
"""


@query(f"select o_orderkey as id, {_hash_sql()} as hash from orders")
def checksum_individual(t: Tables):
    return R.individual(t.orders, "o_orderkey", FIELDS)


@query(f"with x as (select {_hash_sql()} as h from orders) select count(*) as qty, {_sums_sql()} from x")
def checksum_batch(t: Tables):
    return _longs(R.batch(t.orders, "o_orderkey", FIELDS))


@query(f"with x as (select floor(o_orderkey / 1000)::bigint as bucket, {_hash_sql()} as h from orders) select bucket, count(*) as qty, {_sums_sql()} from x group by bucket")
def checksum_batch_by_nibble(t: Tables):
    return _longs(R.batch(t.orders, "o_orderkey", FIELDS, R.bucket_of(F.col("o_orderkey"), 1000)))


@query("select min(o_orderkey) as min, max(o_orderkey) as max, count(o_orderkey) as total from orders")
def checksum_range(t: Tables):
    return R.id_range(t.orders, "o_orderkey")


@query("""with x as (select min(struct_pack(a := l_orderkey, b := l_linenumber)) as lo, max(struct_pack(a := l_orderkey, b := l_linenumber)) as hi, count(*) as total from lineitem)
select lo.a as min_l_orderkey, lo.b as min_l_linenumber, hi.a as max_l_orderkey, hi.b as max_l_linenumber, total from x""")
def range_composite(t: Tables):
    return R.composite_range(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""with x as (select o_orderkey as id, floor((row_number() over (order by o_orderkey) - 1) / 1000)::bigint as bucket from orders)
select bucket, min(id) as start, max(id) as "end", count(*) as qty from x group by bucket""")
def nibble_bounds(t: Tables):
    return R.nibbles(t.orders, "o_orderkey", 1000)


@query("select o_orderkey from orders order by o_orderkey offset 999 limit 2")
def nibble_page(t: Tables):
    return R.nibble(t.orders, ["o_orderkey"], 1000)


@query("select o_orderkey from orders order by o_orderkey desc offset 999 limit 2")
def nibble_page_reverse(t: Tables):
    return R.nibble(t.orders, ["o_orderkey"], 1000, reverse=True)


@query("select l_orderkey, l_linenumber from lineitem where (l_orderkey, l_linenumber) >= (500, 3) order by l_orderkey, l_linenumber offset 99 limit 2")
def nibble_composite(t: Tables):
    return R.nibble(t.lineitem, ["l_orderkey", "l_linenumber"], 100, (500, 3))


@query("select o_orderkey from orders where o_orderkey between 100 and 900")
def get_ids_range(t: Tables):
    return TableAdapter(t.spark, t.orders, "o_orderkey", FIELDS).get_ids(100, 900)


@query(_SIDES + "select id, status from d")
def reconcile_diff(t: Tables):
    return R.diff(*_sides(t), "o_orderkey", FIELDS)


@query(_SIDES + "select count(*) filter (where status = 'correct') as correct, count(*) filter (where status = 'incorrect') as incorrect, count(*) filter (where status = 'missing') as missing, count(*) filter (where status = 'extra') as extra from d")
def reconcile_totals(t: Tables):
    return R.totals(R.diff(*_sides(t), "o_orderkey", FIELDS))


@query(_SIDES + "select id, status from d where status <> 'correct'")
def reconcile_drilldown(t: Tables):
    return R.drilldown(*_sides(t), "o_orderkey", FIELDS)


@query(_SIDES + """, mb as (select floor(id / 1000)::bigint as bucket, count(*) as q from m group by 1), sb as (select floor(id / 1000)::bigint as bucket, count(*) as q from s group by 1),
bad as (select distinct floor(id / 1000)::bigint as bucket from d where status <> 'correct')
select bad.bucket, coalesce(mb.q, 0) as master_qty, coalesce(sb.q, 0) as slave_qty, case when coalesce(sb.q, 0) < coalesce(mb.q, 0) then 'too few' when coalesce(sb.q, 0) > coalesce(mb.q, 0) then 'too many' else 'mismatch' end as reason
from bad left join mb on mb.bucket = bad.bucket left join sb on sb.bucket = bad.bucket""")
def reconcile_batches(t: Tables):
    m, s = _sides(t)
    by = R.bucket_of(F.col("o_orderkey"), 1000)
    return R.compare_batches(R.batch(m, "o_orderkey", FIELDS, by), R.batch(s, "o_orderkey", FIELDS, by))


@query("""select o_orderkey as id, 'o_totalprice' as field, o_totalprice::decimal(38,2)::varchar as master, (o_totalprice + 1)::decimal(38,2)::varchar as slave
from orders where o_orderkey % 13 = 0 and o_orderkey % 17 <> 0 and o_orderkey % 19 <> 0""")
def reconcile_sample_fields(t: Tables):
    return R.field_differences(*_sides(t), "o_orderkey", FIELDS)


@query("select o_orderkey, o_custkey from orders where o_orderkey % 19 <> 0 and o_orderkey % 17 <> 0")
def reconcile_prune(t: Tables):
    m, s = _sides(t)
    return R.prune(s, m, "o_orderkey").select("o_orderkey", "o_custkey")


@query("select o_orderkey from orders where o_orderkey not between 100 and 2000 or o_orderkey % 10 = 0")
def delete_range(t: Tables):
    return R.delete_ids(t.orders, "o_orderkey", start=100, end=2000, not_ids=t.orders.where("o_orderkey % 10 = 0")).select("o_orderkey")


@query("select o_orderkey, (o_orderkey % 7 = 0) as _deleted from orders")
def delete_soft(t: Tables):
    return R.delete_ids(t.orders, "o_orderkey", t.orders.where("o_orderkey % 7 = 0"), soft="_deleted").select("o_orderkey", "_deleted")


@query("select o_orderkey, o_orderstatus from orders where (o_orderstatus = 'F' or (o_totalprice > 200000 and o_custkey in (1, 2, 3, 5, 8))) and o_orderkey % 2 = 0")
def where_tree_filter(t: Tables):
    tree = [{"or": [{"o_orderstatus": "F"}, {"and": [{"field": "o_totalprice", "op": ">", "value": 200000}, {"field": "o_custkey", "op": "in", "value": [1, 2, 3, 5, 8]}]}]}, {"_": "o_orderkey % 2 = 0"}]
    return t.orders.where(where_tree(tree)).select("o_orderkey", "o_orderstatus")
