"""Warehouse queries: validation, folding, facts, dimensions, links, evolution, exchange."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.scalars import date_key, normalise_fields, time_key
from tallyweave.functions.validation import Field, Table, errors, expand_deletes
from tallyweave.operators import load as L
from tallyweave.operators import warehouse as W
from tallyweave.plans.base import Tables, register

QUERIES: dict = {}
ORACLES: dict = {}
query = register(QUERIES, ORACLES)

AUDIT = "1998-01-01 00:00:00"
CUSTOMERS = Table("d_customer", (Field("d_id", "bigint", sk=True), Field("c_custkey", "bigint", nk=True), Field("c_name", scd=1), Field("c_mktsegment", scd=2), Field("c_nationkey", "integer", scd=3)), True)


def _base(t: Tables, **more):
    """A first load of the customers, with key c_custkey + 10000."""
    c = t.customer.select((F.col("c_custkey") + 10000).alias("d_id"), "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    c = c.withColumn("_auditdate", F.lit("1995-01-01 00:00:00").cast("timestamp")).withColumn("_startdate", F.lit(W.START).cast("timestamp")).withColumn("_enddate", F.lit(W.END).cast("timestamp")).withColumn("_current", F.lit(True))
    return c.withColumns(more) if more else c


def _texts(df):
    """Times as text, which both engines write alike."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in df.dtypes])


@query("""with x as (select event_id, case when event_id % 7 = 0 then null else user_id end as user_id, case when event_id % 11 = 0 then 'bogus' else event_type end as event_type, case when event_id % 13 = 0 then 'x1' else event_id::varchar end as amount from events)
select event_id, concat_ws(';', case when user_id is null then 'user_id: key missing' end, case when event_type not in ('signup', 'purchase', 'error', 'view', 'click') then 'event_type: not an allowed value' end, case when amount = 'x1' then 'amount: no integer' end) as errors
from x where event_id % 7 = 0 or event_id % 11 = 0 or event_id % 13 = 0""")
def validate_events(t: Tables):
    spec = Table("f_events", (Field("event_id", "bigint", nk=True), Field("user_id", "bigint", nk=True), Field("event_type", "varchar(20)", values=("signup", "purchase", "error", "view", "click")), Field("amount", "integer")))
    hurt = lambda n, bad, c: F.when(F.col("event_id") % n == 0, bad).otherwise(c)
    rows = t.events.select("event_id", hurt(7, F.lit(None), F.col("user_id")).alias("user_id"), hurt(11, F.lit("bogus"), F.col("event_type")).alias("event_type"), hurt(13, F.lit("x1"), F.col("event_id").cast("string")).alias("amount"))
    return rows.select("event_id", F.array_join(errors(rows, spec), ";").alias("errors")).where("errors <> ''")


@query("select o_orderkey as event_id, e.type, e.entity, e.field, i.id, '_del_' || i.id as key from orders, (values (o_orderkey), (o_custkey)) i(id), (values ('fact', 'order', 'id'), ('dimension', 'customer', 'custkey')) e(type, entity, field)")
def delete_expand(t: Tables):
    entity = lambda a, b, c: F.struct(F.lit(a).alias("type"), F.lit(b).alias("name"), F.lit(c).alias("field"))
    events = t.orders.select(F.col("o_orderkey").alias("event_id"), F.array("o_orderkey", "o_custkey").alias("ids"), F.array(entity("fact", "order", "id"), entity("dimension", "customer", "custkey")).alias("entities"))
    return expand_deletes(events)


@query("select doc_id as document_id, substr(text, 1, 4000) as text_body, lang as written_in, n_chars as n_chars_ts from documents")
def normalize_fields(t: Tables):
    return normalise_fields(t.documents.select(F.col("doc_id").alias("Ref:Document"), F.col("text").alias("Text-Body"), F.col("lang").alias("Written In"), F.col("n_chars").alias("Ts:n_chars")))


@query("""with gone as (select user_id, max(event_id) as g from events where event_type = 'error' group by 1),
e as (select v.*, g from events v left join gone on v.user_id = gone.user_id where g is null or event_id >= g)
select user_id, arg_max(value, event_id) filter (where event_type = 'purchase') as purchase, arg_max(props, event_id) filter (where event_type <> 'error') as props, arg_max(event_type = 'error', event_id) as _deleted from e group by user_id""")
def fold_events(t: Tables):
    rows = t.events.select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase"), "props", (F.col("event_type") == "error").alias("gone"))
    return W.fold(rows, ["user_id"], "event_id", ["purchase", "props"], "gone")


def _facts(t: Tables):
    o = t.orders
    fact = o.where("o_orderkey % 10 <> 0").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    staged = o.where("o_orderkey % 5 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "X").alias("o_orderstatus"), "o_orderpriority")
    return fact, staged


@query("""with f as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderkey % 10 <> 0),
s as (select o_orderkey, case when o_orderkey % 3 = 0 then 'X' end as o_orderstatus, o_orderpriority from orders where o_orderkey % 5 = 0)
select coalesce(s.o_orderkey, f.o_orderkey) as o_orderkey, o_custkey, coalesce(s.o_orderstatus, f.o_orderstatus) as o_orderstatus, o_totalprice, o_orderpriority, case when s.o_orderkey is not null then '1998-01-01 00:00:00' end as _auditdate, false as _deleted
from f full join s on f.o_orderkey = s.o_orderkey""")
def fact_upsert(t: Tables):
    return _texts(W.fact_upsert(*_facts(t), ["o_orderkey"], AUDIT))


@query("select o_orderkey, o_custkey, case when o_orderkey % 9 = 0 then '1998-01-01 00:00:00' end as _auditdate, o_orderkey % 9 = 0 as _deleted from orders")
def fact_soft_delete(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey")
    return _texts(W.soft_delete_fact(o, o.where("o_orderkey % 9 = 0"), "o_orderkey", AUDIT))


@query("select c_custkey, case when c_custkey % 9 = 0 then '1998-01-01 00:00:00' else '9999-01-01 00:00:00' end as _enddate, c_custkey % 9 <> 0 as _current from customer")
def dimension_soft_delete(t: Tables):
    dim = _base(t)
    return _texts(W.soft_delete_dimension(dim, dim.where("c_custkey % 9 = 0"), "c_custkey", AUDIT).select("c_custkey", "_enddate", "_current"))


@query("select c_custkey + 10000 as d_id, c_custkey, case when c_custkey % 7 = 0 then 'renamed' else c_name end as c_name, c_mktsegment, '9999-01-01 00:00:00' as _enddate, true as _current from customer")
def scd1_update(t: Tables):
    staged = t.customer.where("c_custkey % 7 = 0").select("c_custkey", F.lit("renamed").alias("c_name"))
    return _texts(W.scd_load(_base(t), staged, CUSTOMERS, AUDIT).select("d_id", "c_custkey", "c_name", "c_mktsegment", "_enddate", "_current"))


_SCD2 = """with base as (select c_custkey + 10000 as d_id, c_custkey, c_mktsegment, c_custkey % 7 = 0 and c_mktsegment <> 'MACHINERY' as chg from customer where c_custkey % 11 <> 0),
fresh as (select c_custkey, false as is_new from base where chg union all select c_custkey, true from customer where c_custkey % 77 = 0),
versions as (
select d_id, c_custkey, c_mktsegment, '1900-01-01 00:00:00' as _startdate, case when chg then '1998-01-01 00:00:00' else '9999-01-01 00:00:00' end as _enddate, not chg as _current from base
union all select (select max(d_id) from base) + row_number() over (order by c_custkey), c_custkey, 'MACHINERY', case when is_new then '1900-01-01 00:00:00' else '1998-01-01 00:00:00' end, '9999-01-01 00:00:00', true from fresh)
"""


def _history(t: Tables, parts: int | None = 8):
    staged = t.customer.where("c_custkey % 7 = 0").select("c_custkey", F.lit("MACHINERY").alias("c_mktsegment"))
    return W.scd_load(_base(t).where("c_custkey % 11 <> 0"), staged, CUSTOMERS, AUDIT, parts)


@query(_SCD2 + "select d_id::bigint as d_id, c_custkey, c_mktsegment, _startdate, _enddate, _current from versions")
def scd2_history(t: Tables):
    return _texts(_history(t, parts=4).select("d_id", "c_custkey", "c_mktsegment", "_startdate", "_enddate", "_current"))


@query("select c_custkey, case when c_custkey % 7 = 0 then 99 else c_nationkey end as c_nationkey, case when c_custkey % 7 = 0 then c_nationkey end as previous_c_nationkey from customer")
def scd3_previous(t: Tables):
    staged = t.customer.where("c_custkey % 7 = 0").select("c_custkey", F.lit(99).alias("c_nationkey"))
    return W.scd_load(_base(t, previous_c_nationkey=F.lit(None).cast("int")), staged, CUSTOMERS, AUDIT).select("c_custkey", "c_nationkey", "previous_c_nationkey")


@query("select c_custkey, c_mktsegment, case when c_custkey % 7 = 0 then 'MACHINERY' else c_mktsegment end as current_c_mktsegment, true as _current from customer")
def scd6_current(t: Tables):
    spec = Table("d_customer", (Field("d_id", "bigint", sk=True), Field("c_custkey", "bigint", nk=True), Field("c_mktsegment", scd=6)), True)
    dim = _base(t, current_c_mktsegment=F.col("c_mktsegment")).drop("c_name", "c_nationkey")
    staged = t.customer.where("c_custkey % 7 = 0").select("c_custkey", F.lit("MACHINERY").alias("c_mktsegment"))
    return W.scd_load(dim, staged, spec, AUDIT).select("c_custkey", "c_mktsegment", "current_c_mktsegment", "_current")


@query("""with d as (select c_custkey, c_custkey + 10000 as d_id, c_name from customer where c_custkey % 5 <> 0),
m as (select distinct o_custkey from orders where o_custkey not in (select c_custkey from d))
select d_id::bigint as d_id, c_custkey, c_name from d union all select (select max(d_id) from d) + row_number() over (order by o_custkey), o_custkey, null from m""")
def missing_dimensions(t: Tables):
    dim = _base(t).where("c_custkey % 5 <> 0")
    return W.missing_members(dim, t.orders, {"c_custkey": "o_custkey"}, "d_id", AUDIT, parts=4).select("d_id", "c_custkey", "c_name")


@query(_SCD2 + """select o_orderkey, coalesce(v.d_id, 1)::bigint as d_customer from orders o left join versions v
on o.o_custkey = v.c_custkey and strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') >= v._startdate and (strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') < v._enddate or v._current)""")
def link_dimensions(t: Tables):
    return W.link(t.orders, _history(t), {"o_custkey": "c_custkey"}, "d_id", "o_orderdate", "d_customer").select("o_orderkey", "d_customer")


@query("select event_id, datediff('day', date '1400-01-01', ts::date)::bigint + 10000 as date_key, (hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) + 10000)::bigint as time_key from events")
def date_time_keys(t: Tables):
    return t.events.select("event_id", date_key(F.col("ts")).alias("date_key"), time_key(F.col("ts")).alias("time_key"))


@query("select c_custkey, c_name, null::bigint as points, null::varchar as note from customer")
def schema_evolve(t: Tables):
    return W.evolve(t.customer.select("c_custkey", "c_name"), W.declared_struct({"c_custkey": "bigint", "points": "bigint", "note": "varchar(20)"}))[0]


@query("select 'Modified' as first, 'Unmodified' as second, 'Created' as third")
def schema_status(t: Tables):
    wanted = W.declared_struct({"c_custkey": "bigint", "points": "bigint"})
    grown, first = W.evolve(t.customer, wanted)
    return t.spark.createDataFrame([(first, W.evolve(grown, wanted)[1], W.evolve(None, wanted, t.spark)[1])], "first string, second string, third string")


@query("select strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as audit, (select count(*) from orders where o_orderdate = (select max(o_orderdate) from orders)) as rows from orders")
def audit_point(t: Tables):
    return _texts(W.audit_point(t.orders, "o_orderdate"))


@query("select o_orderkey, o_custkey from orders where o_orderdate >= timestamp '1998-01-01'")
def audit_export(t: Tables):
    return W.export_changes(t.orders, AUDIT, 0, "o_orderdate").select("o_orderkey", "o_custkey")


@query("select o_orderkey, case when o_orderkey % 4 = 0 then 0 else o_custkey end as o_custkey from orders")
def audit_import(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey")
    return W.import_changes(o.where("o_orderkey % 8 <> 0"), o.where("o_orderkey % 4 = 0").withColumn("o_custkey", F.lit(0).cast("long")), ["o_orderkey"])


LOAD_CUSTOMERS = Table("d_customer", (Field("d_id", "bigint", sk=True), Field("c_custkey", "bigint", nk=True), Field("c_name", scd=1), Field("c_mktsegment", scd=2)), True)
LOAD_ORDERS = Table("f_order", (Field("o_orderkey", "bigint", nk=True), Field("o_custkey", "bigint", dimension="d_customer"), Field("o_orderstatus", "varchar(1)"), Field("o_orderpriority", "varchar(15)"), Field("ordered", "timestamp", dimension="d_date")), label="order")


def _loaded(t: Tables):
    """Customers without every fifth and every third order, then events: segments, new orders and priorities, bad ones, deletes."""
    dim = _base(t).where("c_custkey % 5 <> 0").drop("c_nationkey")
    fact = t.orders.where("o_orderkey % 3 = 0").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.lit("1995-01-01 00:00:00").cast("timestamp").alias("_auditdate"), F.lit(False).alias("_deleted"))
    text = lambda **columns: F.create_map(*[x for n, c in columns.items() for x in (F.lit(n), (F.col(c) if isinstance(c, str) else c).cast("string"))])
    event = lambda df, kind, table, seq, data: df.select(F.expr(seq).alias("seq"), F.lit(kind).alias("type"), F.lit(table).alias("table"), data.alias("data"), F.lit(None).cast("array<string>").alias("ids"), F.lit(None).cast("array<struct<type: string, name: string, field: string>>").alias("entities"))
    parts = [
        event(t.customer.where("c_custkey % 7 = 0 and c_custkey % 5 <> 0"), "dimension", "d_customer", "c_custkey", text(c_custkey="c_custkey", c_mktsegment=F.lit("MACHINERY"))),
        event(t.orders.where("o_orderkey % 2 = 0"), "fact", "order", "10000000 + o_orderkey", text(o_orderkey="o_orderkey", o_custkey="o_custkey", o_orderstatus=F.lit("N"), ordered=F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))),
        event(t.orders.where("o_orderkey % 6 = 0"), "fact", "f_order", "20000000 + o_orderkey", text(o_orderkey="o_orderkey", o_orderpriority=F.lit("P"))),
        event(t.orders.where("o_orderkey % 11 = 1"), "fact", "f_order", "30000000 + o_orderkey", text(o_orderkey="o_orderkey", o_orderstatus=F.lit("LONG"))),
        event(t.orders.where("o_orderkey % 11 = 2"), "fact", "f_order", "40000000 + o_orderkey", text(o_orderkey="o_orderkey", color=F.lit("red"))),
        event(t.orders.where("o_orderkey % 11 = 3"), "fact", "f_other", "50000000 + o_orderkey", text(o_orderkey="o_orderkey")),
    ]
    gone = t.orders.where("o_orderkey % 10 = 0").select((F.lit(60000000) + F.col("o_orderkey")).alias("seq"), F.lit("delete").alias("type"), F.lit(None).cast("string").alias("table"), F.lit(None).cast("map<string,string>").alias("data"), F.array(F.col("o_orderkey").cast("string")).alias("ids"), F.array(F.struct(F.lit("fact").alias("type"), F.lit("f_order").alias("name"), F.lit("o_orderkey").alias("field"))).alias("entities"))
    events = gone
    for p in parts:
        events = events.unionByName(p)
    return L.load(t.spark, [LOAD_CUSTOMERS, LOAD_ORDERS], {"d_customer": dim, "f_order": fact}, events, AUDIT)


_LOAD = """with base as (select c_custkey + 10000 as d_id, c_custkey, c_mktsegment, c_custkey % 7 = 0 and c_mktsegment <> 'MACHINERY' as chg from customer where c_custkey % 5 <> 0),
fresh as (select (select max(d_id) from base) + row_number() over (order by c_custkey) as d_id, c_custkey from base where chg),
old as (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders where o_orderkey % 3 = 0),
ev as (select o_orderkey, o_orderkey % 10 = 0 as gone, o_custkey, o_orderdate, case when o_orderkey % 6 = 0 then 'P' end as prio from orders where o_orderkey % 2 = 0),
fact as (select coalesce(ev.o_orderkey, old.o_orderkey) as o_orderkey, coalesce(case when not gone then ev.o_custkey end, old.o_custkey) as o_custkey,
  coalesce(case when not gone then 'N' end, old.o_orderstatus) as o_orderstatus, coalesce(case when not gone then prio end, old.o_orderpriority) as o_orderpriority,
  ev.o_orderkey is not null as touched, coalesce(gone, false) as _deleted, case when not gone then o_orderdate end as ordered from old full join ev on old.o_orderkey = ev.o_orderkey),
lacking as (select distinct o_custkey from fact where touched and o_custkey is not null and o_custkey not in (select c_custkey from base)),
missing as (select (select coalesce(max(d_id), (select max(d_id) from base)) from fresh) + row_number() over (order by o_custkey) as d_id, o_custkey as c_custkey from lacking),
dim as (select d_id, c_custkey, c_mktsegment, '1900-01-01 00:00:00' as _startdate, not chg as _current from base
  union all select d_id, c_custkey, 'MACHINERY', '1998-01-01 00:00:00', true from fresh union all select d_id, c_custkey, null, '1900-01-01 00:00:00', true from missing)
"""


@query(_LOAD + """select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, _deleted, case when touched then '1998-01-01 00:00:00' else '1995-01-01 00:00:00' end as _auditdate,
case when touched then coalesce(d.d_id, 1)::bigint end as d_o_custkey, case when touched then coalesce(datediff('day', date '1400-01-01', ordered::date)::bigint + 10000, 1) end as d_ordered_date
from fact left join dim d on d.c_custkey = fact.o_custkey and d._current""")
def warehouse_load(t: Tables):
    """Facts after a whole load: folded, upserted, deleted, linked to customers and dates."""
    return _texts(_loaded(t).tables["f_order"].drop("ordered"))


@query(_LOAD + "select d_id::bigint as d_id, c_custkey, c_mktsegment, _startdate, _current from dim")
def warehouse_load_dimension(t: Tables):
    return _texts(_loaded(t).tables["d_customer"].select("d_id", "c_custkey", "c_mktsegment", "_startdate", "_current"))


@query("""select 30000000 + o_orderkey as seq, 'f_order' as "table", 'o_orderstatus: longer than 1' as errors from orders where o_orderkey % 11 = 1
union all select 40000000 + o_orderkey, 'f_order', 'color: unknown field' from orders where o_orderkey % 11 = 2 union all select 50000000 + o_orderkey, 'f_other', 'no matching table' from orders where o_orderkey % 11 = 3""")
def warehouse_load_rejected(t: Tables):
    return _loaded(t).rejected.withColumn("errors", F.array_join("errors", ";"))


@query(_SCD2 + """select o_orderkey, o_linenumber, coalesce(v.d_id, 1)::bigint as d_customer, coalesce(p.d_id, 1)::bigint as d_line, datediff('day', date '1400-01-01', o_orderdate::date)::bigint + 10000 as d_at_date,
(hour(o_orderdate) * 3600 + minute(o_orderdate) * 60 + floor(second(o_orderdate)) + 10000)::bigint as d_at_time
from (select o_orderkey, o_custkey, o_orderdate, (o_orderkey % 9)::bigint as o_linenumber from orders) o
left join versions v on o.o_custkey = v.c_custkey and strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') >= v._startdate and (strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') < v._enddate or v._current)
left join (select c_custkey as a, (c_custkey % 9)::bigint as b, c_custkey + 50000 as d_id from customer) p on p.a = o.o_custkey and p.b = o.o_linenumber""")
def link_all(t: Tables):
    """Several links at once: versions by time, a key of two columns, and parts of a point in time."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("at"), (F.col("o_orderkey") % 9).alias("o_linenumber"))
    pairs = t.customer.select(F.col("c_custkey").alias("a"), (F.col("c_custkey") % 9).alias("b"), (F.col("c_custkey") + 50000).alias("d_id"), F.lit(W.START).cast("timestamp").alias("_startdate"), F.lit(W.END).cast("timestamp").alias("_enddate"), F.lit(True).alias("_current"))
    links = [L.Link("d_customer", {"o_custkey": "c_custkey"}, "d_customer", at="at"), L.Link("d_line", {"o_custkey": "a", "o_linenumber": "b"}, "d_line", at="at"), L.Link("d_datetime", {"at": ""}, "d_at")]
    return L.link_all(rows, links, {"d_customer": _history(t, 4), "d_line": pairs}).drop("o_custkey", "at")


@query("select strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') as oldest, count(*) as n from orders where o_orderdate >= timestamp '1998-01-01'")
def audit_export_stats(t: Tables):
    return _texts(W.export_stats(W.export_changes(t.orders, AUDIT, 0, "o_orderdate"), "o_orderdate"))


@query("select o_orderkey from orders where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < timestamp '1998-01-01')")
def audit_export_after(t: Tables):
    """The remote has all rows of its audit time: only later ones go."""
    point = W.audit_point(t.orders.where("o_orderdate < timestamp '1998-01-01'"), "o_orderdate").first()
    return W.export_changes(t.orders, point["audit"], point["rows"], "o_orderdate").select("o_orderkey")


@query("""select 'd_id' as name, 'bigint' as type union all select 'c_custkey', 'bigint' union all select 'c_name', 'string' union all select 'c_mktsegment', 'string'
union all select '_auditdate', 'timestamp' union all select '_startdate', 'timestamp' union all select '_enddate', 'timestamp' union all select '_current', 'boolean'""")
def table_created(t: Tables):
    made = W.create_table(t.spark, LOAD_CUSTOMERS)
    return t.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in made.schema], "name string, type string")
