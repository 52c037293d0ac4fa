"""Sources, sinks and streams over the driver's tables: each query writes what it reads to the shared folder first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.nested import merged
from tallyweave.functions.scalars import date_key, deflate, fk_column, for_load, inflate, iso_time, time_key
from tallyweave.operators import aggregates as A
from tallyweave.operators import changes as C
from tallyweave.operators import domain as D
from tallyweave.operators import entity as E
from tallyweave.operators import reconcile as R
from tallyweave.operators import runs
from tallyweave.plans import checks, feeds
from tallyweave.plans.base import Tables, register
from tallyweave.session import scratch
from tallyweave.sources import adapters, files, http, search, storage
from tallyweave.streaming import aggregator as S
from tallyweave.streaming import replay

QUERIES: dict = {}
ORACLES: dict = {}
query = register(QUERIES, ORACLES)


@query("select o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as at from orders where o_orderkey > 100")
def copy_round_trip(t: Tables):
    """Delimited files written and loaded again."""
    path = scratch(t.spark)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"))
    files.copy_out(rows, path, where=F.col("o_orderkey") > 100)
    return files.copy_in(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, at string")


@query("select c_custkey, c_name from customer")
def unload_manifest(t: Tables):
    path = scratch(t.spark)
    files.unload(t.customer, path, ["c_custkey", "c_name"])
    return files.load_manifest(t.spark, path, "c_custkey bigint, c_name string")


@query("select c_custkey, c_mktsegment from customer")
def table_published(t: Tables):
    """Two versions, of which readers see the later."""
    path = scratch(t.spark)
    files.publish(t.customer.select("c_custkey", F.lit("old").alias("c_mktsegment")), path, 1)
    files.publish(t.customer.select("c_custkey", "c_mktsegment"), path, 2)
    return files.published(t.spark, path)


@query("select distinct o_custkey as id from orders")
def id_file(t: Tables):
    path = scratch(t.spark)
    t.orders.select(F.col("o_custkey").cast("string")).distinct().write.text(path)
    return files.id_file(t.spark, path)


@query("""with w as (select distinct o_custkey as id from orders) select id, 'update' as last_op, c_name, c_custkey is null as deleted from w left join customer on id = c_custkey""")
def cdc_bulk_enrich(t: Tables):
    """Ids from files as if each had been updated, with the rows as they are now."""
    path = scratch(t.spark)
    t.orders.select(F.col("o_custkey").cast("string")).distinct().write.text(path)
    return replay.enrich_ids(t.spark, path, t.customer.select(F.col("c_custkey").alias("id"), "c_name")).drop("last_seq")


@query(checks._SIDES + "select id, status, 'orders' as queue from d where status <> 'correct'")
def diff_queue(t: Tables):
    """What differs, as a queue gets it: through a transform, written and read back."""
    path = scratch(t.spark)
    _, found = R.reconcile(*checks._sides(t), "o_orderkey", checks.FIELDS, lambda df: df.withColumn("queue", F.lit("orders")))
    found.write.json(path)
    return t.spark.read.schema("id bigint, status string, queue string").json(path)


@query("select o_orderkey, 'orders: no good' as errors, 'orders_error' as queue from orders where o_orderkey % 3 = 0")
def error_queue(t: Tables):
    path = scratch(t.spark)
    files.quarantine(t.orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.array(F.lit("orders: no good")).alias("errors")), "orders", path)
    return t.spark.read.schema("o_orderkey bigint, errors array<string>, queue string").json(f"{path}/orders_error").withColumn("errors", F.array_join("errors", ";"))


@query("select o_orderkey, o_custkey from orders where floor(o_orderkey / 1000) <> 1")
def snapshot_written(t: Tables):
    """Pages of documents, without one that an earlier run had written."""
    path = scratch(t.spark)
    D.write_snapshot(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 1000, path, [1])
    return t.spark.read.schema("o_orderkey bigint, o_custkey bigint").json(f"{path}/page=*")


@query("select c_custkey::varchar as id, case when c_custkey % 3 = 0 then 'none' else c_name end as name from customer")
def entity_load(t: Tables):
    """Records with partition and id, transformed on the way; rows without a key are told apart."""
    rows = t.customer.unionByName(t.customer.limit(0)).select(F.col("c_custkey").cast("string").alias("key"), "c_name")
    good, _ = E.load(rows.unionByName(t.spark.createDataFrame([(None, "lost"), ("", "lost")], "key string, c_name string")), "customer", "key", lambda df: df.select("key", F.when(F.col("key").cast("int") % 3 == 0, "none").otherwise(F.col("c_name")).alias("name")))
    return good.select("id", "name")


@query("""with w as (select o_custkey, arg_max(o_orderkey, o_orderkey) as last_order, max(o_orderkey) as seq from orders group by 1)
select c_custkey, c_name, last_order from customer left join w on o_custkey = c_custkey""")
def entity_nested_merge(t: Tables):
    """Objects within objects keep what a write leaves out."""
    stored = t.customer.select("c_custkey", F.struct(F.col("c_name").alias("name"), F.lit(None).cast("bigint").alias("last_order")).alias("info"))
    written = t.orders.join(t.customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.col("o_custkey").alias("c_custkey"), F.struct(F.lit(None).cast("string").alias("name"), F.col("o_orderkey").alias("last_order")).alias("info"), F.col("o_orderkey").alias("seq"))
    return E.merge(stored, written, ["c_custkey"], "seq").select("c_custkey", F.col("info.name").alias("c_name"), F.col("info.last_order").alias("last_order"))


@query("""select c_custkey, c_name, false as fresh from customer where c_custkey % 4 <> 0 and (c_custkey + 1) % 4 <> 0
union all select c_custkey, 'Customer of ' || (c_custkey - 1), false from customer where c_custkey % 4 = 0
union all select c_custkey, 'Customer of ' || c_custkey, false from customer where (c_custkey + 1) % 4 = 0 and c_custkey + 1 not in (select c_custkey from customer)
union all select 1000000 + c_custkey, 'new ' || c_custkey, true from customer where c_custkey % 10 = 0""")
def entity_unique_upsert(t: Tables):
    """Every fourth customer takes the name of the one before, which gives way as names are unique; some are new."""
    stored = t.customer.select("c_custkey", F.when((F.col("c_custkey") + 1) % 4 == 0, F.concat(F.lit("Customer of "), F.col("c_custkey"))).otherwise(F.col("c_name")).alias("c_name"))
    written = t.customer.where("c_custkey % 4 = 0").select("c_custkey", F.concat(F.lit("Customer of "), F.col("c_custkey") - 1).alias("c_name"))
    written = written.unionByName(t.customer.where("c_custkey % 10 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), F.concat(F.lit("new "), F.col("c_custkey")).alias("c_name"))).withColumn("seq", F.col("c_custkey"))
    after, fresh = E.upsert_unique(stored, written, ["c_custkey"], [["c_name"]], "seq")
    return after.join(fresh.withColumn("fresh", F.lit(True)), "c_custkey", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))


@query("select o_orderkey, o_custkey from orders where o_orderkey between 100 and 9000 and o_orderstatus in ('F', 'O') and not o_custkey = 7")
def search_query(t: Tables):
    """A request of the query language over a table."""
    asked = search.request({"bool": {"must": [search.all_of(search.between("o_orderkey", 100, 9000), search.any_of("o_orderstatus", ["F", "O"]))], "must_not": [{"term": {"o_custkey": 7}}]}}, source=["o_orderkey", "o_custkey"])
    return search.found(t.orders, asked)


@query("select o_orderkey from orders where o_orderstatus = 'P' or o_orderkey <= 500 order by o_orderkey")
def search_ids(t: Tables):
    return search.ids_of(t.orders, [search.any_of("o_orderstatus", ["P"]), search.between("o_orderkey", end=500)], "o_orderkey")


@query("select o_orderstatus, count(*) as n, max(o_orderkey) as last from orders where o_orderkey >= 100 group by 1")
def search_aggregations(t: Tables):
    return search.found(t.orders, search.request(search.between("o_orderkey", 100))).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))


@query("select c_custkey::varchar as id, c_name from customer")
def search_scroll(t: Tables):
    """Pages of a service that answers from a folder of hits: scrolled by tasks, each a slice."""
    path = scratch(t.spark)
    t.customer.select(F.to_json(F.struct(F.col("c_custkey").cast("string").alias("_id"), F.struct("c_name").alias("_source"))).alias("hit"), (F.col("c_custkey") % 4).alias("slice")).write.parquet(path)
    hits = t.spark.read.parquet(path)

    def slices(batches):
        import json

        import pandas as pd

        for batch in batches:
            for part, own in batch.groupby("slice"):
                left = [json.loads(h) for h in own["hit"]]

                def fetch(_, body, left=left):
                    page, left[:] = left[:100], left[100:]
                    return {"hits": {"hits": page}, "_scroll_id": "next"}

                found = list(http.scroll(fetch, "http://search", search.request(search.all_of()), 100, 1_000_000, (int(part), 4), lambda h: (h["_id"], h["_source"]["c_name"])))
                yield pd.DataFrame(found, columns=["id", "c_name"])

    return hits.mapInPandas(slices, "id string, c_name string")


@query("select c_custkey, upper(c_name) as name from customer where c_custkey between 10 and 900 and c_mktsegment <> 'BUILDING'")
def document_range(t: Tables):
    """A range of documents kept as JSON, with a condition, a projection and a mapper that leaves some out."""
    path = scratch(t.spark)
    t.customer.select("c_custkey", "c_name", "c_mktsegment").write.json(path)
    mapper = lambda d: None if d["c_mktsegment"] == "BUILDING" else {"c_custkey": d["c_custkey"], "name": d["c_name"].upper()}
    return adapters.DocumentAdapter(t.spark, path, "c_custkey", ["name"], "c_custkey is not null", mapper, "c_custkey bigint, name string").find(10, 900)


@query("select o_orderkey * 2 as id, o_custkey from orders where o_orderkey * 2 between 200 and 4000")
def adapter_ids(t: Tables):
    """An adapter whose ids come from a function of the key: filtered and given back in that form."""
    own = adapters.TableAdapter(t.spark, t.orders, "o_orderkey", ["o_custkey"], extract_id=lambda c: c * 2)
    rows = own.rows(None, 200, 4000).select((F.col("o_orderkey") * 2).alias("id"), "o_custkey")
    return rows.join(own.get_ids(200, 4000).withColumnRenamed("o_orderkey", "id"), "id", "left_semi")


@query("select o_orderkey as id, md5(coalesce(md5(o_custkey::varchar), ' ') || coalesce(md5(o_orderstatus), ' ')) as hash from orders where o_orderkey between 100 and 900")
def adapter_files(t: Tables):
    """Hashes of a range of a table kept in files, by request."""
    path = scratch(t.spark)
    t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").write.parquet(path)
    return adapters.FileAdapter(t.spark, path, "o_orderkey", ["o_custkey", "o_orderstatus"]).handle("individual", start=100, end=900)


@query("select o_orderkey, o_custkey, o_orderstatus from orders where o_orderkey in (1, 5, 7, 33, 100, 104)")
def adapter_sample(t: Tables):
    return adapters.TableAdapter(t.spark, t.orders, "o_orderkey", ["o_custkey", "o_orderstatus"]).handle("sample", ids=[1, 5, 7, 33, 100, 104])


@query("select count(*) filter (where (c_custkey - least) % 7 <> 6) as correct, count(*) filter (where (c_custkey - least) % 7 = 6) as incorrect, 0::bigint as missing, 0::bigint as extra from customer, (select min(c_custkey) as least from customer)")
def adapter_mock(t: Tables):
    n = t.customer.count()
    return R.totals(adapters.compare(adapters.MockAdapter(t.spark, n), adapters.MockAdapter(t.spark, n, wrong_every=7)))


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_custkey % 3 = 0)")
def delete_by_query(t: Tables):
    return R.delete_by(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.customer.where("c_custkey % 3 = 0").select("c_custkey"))


@query(checks._SIDES + "select count(*) filter (where status = 'correct') as correct, count(*) filter (where status = 'incorrect') as incorrect, count(*) filter (where status = 'missing') as missing, count(*) filter (where status = 'extra') as extra from d")
def reconcile_session(t: Tables):
    """A run in bites that stops twice, is saved, and goes on: its totals are those of one job."""
    m, s = checks._sides(t)
    root, limit = scratch(t.spark), max(1, t.orders.count() // 12)
    save = runs.saver(t.spark, root)
    state = runs.run(m, s, "o_orderkey", checks.FIELDS, None, limit, stop_bites=2, save=save)
    state = runs.run(m, s, "o_orderkey", checks.FIELDS, runs.stored(t.spark, root), limit, stop_streak=1, stop_bites=3, save=save)
    while state["status"] != "complete":
        state = runs.run(m, s, "o_orderkey", checks.FIELDS, runs.stored(t.spark, root), limit, save=save)
    return t.spark.createDataFrame([tuple(state["totals"][x] for x in runs.STATUSES)], "correct long, incorrect long, missing long, extra long")


@query("""with m as (select 'k' || o_orderkey as id, o_custkey as v from orders where o_orderkey % 17 <> 0), s as (select 'k' || o_orderkey as id, case when o_orderkey % 13 = 0 then -1 else o_custkey end as v from orders where o_orderkey % 19 <> 0)
select coalesce(m.id, s.id) as id, case when s.id is null then 'missing' when m.id is null then 'extra' else 'incorrect' end as status from m full join s on m.id = s.id where s.id is null or m.id is null or m.v <> s.v""")
def reconcile_text_ids(t: Tables):
    """Ids that are texts go to hash buckets."""
    text = t.orders.select(F.concat(F.lit("k"), F.col("o_orderkey")).alias("id"), F.col("o_custkey").alias("v"), "o_orderkey")
    slave = text.where("o_orderkey % 19 <> 0").withColumn("v", F.when(F.col("o_orderkey") % 13 == 0, F.lit(-1).cast("long")).otherwise(F.col("v")))
    return R.drilldown(text.where("o_orderkey % 17 <> 0"), slave, "id", ["v"])


@query("""with m as (select l_orderkey as id, count(*) as n, sum(l_linenumber) as v from lineitem group by 1), s as (select l_orderkey as id, count(*) as n, sum(l_linenumber) as v from lineitem where l_orderkey % 5 <> 0 or l_linenumber <> 1 group by 1)
select m.id, case when s.id is null then 'missing' when m.n = s.n then 'correct' else 'incorrect' end as status from m left join s on m.id = s.id""")
def reconcile_repeated_ids(t: Tables):
    """All rows of an id are compared as a whole."""
    return R.diff(t.lineitem, t.lineitem.where("l_orderkey % 5 <> 0 or l_linenumber <> 1"), "l_orderkey", ["l_linenumber"])


@query("select o_orderkey, 'missing' as status from orders where o_orderkey between 1000 and 1100")
def reconcile_few_buckets(t: Tables):
    """Where few buckets differ, only their range is read again."""
    return R.drilldown(t.orders, t.orders.where("o_orderkey not between 1000 and 1100"), "o_orderkey", checks.FIELDS).withColumnRenamed("id", "o_orderkey")


@query("select 'orders' as name, 'o_orderkey' as column, 'bigint' as type union all select 'orders', 'o_custkey', 'bigint' union all select 'orders', 'o_orderstatus', 'string'")
def describe_tables(t: Tables):
    """What tables are there and what columns they have."""
    own = {"orders": adapters.TableAdapter(t.spark, t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey", [])}
    return t.spark.createDataFrame([(n, f.name, f.dataType.simpleString()) for n, a in own.items() for f in a.describe()], "name string, column string, type string")


def _files(t: Tables, rows, fmt: str = "json", parts: int = 4) -> str:
    path = scratch(t.spark)
    (rows.repartitionByRange(parts, rows.columns[0]) if fmt == "json" else rows).write.format(fmt).save(path)
    return path


@query("""with f as (select case when event_type = 'error' then 'delete' else 'update' end as op, event_type as "table", user_id, event_id from events where event_id > 100 and event_type <> 'click' and user_id is not null)
select op, "table", count(distinct user_id) as ids, min(user_id) as least from f group by 1, 2""")
def cdc_row_log(t: Tables):
    """A row log from a position on, folded batch by batch; what all batches have is what one fold would have."""
    log = t.events.select(F.col("event_id").alias("position"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "error", "delete").when(F.col("event_id") % 2 == 0, "write").otherwise("update").alias("kind"), F.when(F.col("event_type") == "click", "other").otherwise("app").alias("schema"), F.col("event_type").alias("table"), F.col("user_id").cast("string").alias("key"))
    stream = replay.row_log(t.spark, _files(t, log), 100, exclude=["other"], stream=True, files=1)
    root, checkpoint = scratch(t.spark), scratch(t.spark)
    replay.folded(stream, root, checkpoint).awaitTermination()
    ids = replay.versions(t.spark, root).select("op", "table", F.explode("ids").alias("id"))
    return ids.groupBy("op", "table").agg(F.count_distinct("id").alias("ids"), F.min(F.col("id").cast("long")).alias("least"))


@query("""select event_id, 'public' as schema, 'events' as tbl, 'UPDATE' as op, '{"id":"' || event_id || '"}' as old, '{"id":"' || event_id || '","kind":"' || replace(event_type, 'e', chr(39)) || '","odd name":null}' as new from events where event_id > 50""")
def cdc_decoded_log(t: Tables):
    """Lines of logical decoding from a log position on, as a stream of files."""
    line = F.format_string("0/%X\ttable public.events: UPDATE: old-key: id[bigint]:%d new-tuple: id[bigint]:%d kind[text]:'%s' \"odd name\"[character varying]:null", "event_id", "event_id", "event_id", F.regexp_replace("event_type", "e", "''"))
    path = scratch(t.spark)
    t.events.select(line).write.text(path)
    out = scratch(t.spark)
    stream = replay.decoded_log(t.spark, path, "0/32", stream=True)
    stream.writeStream.foreachBatch(lambda rows, batch: storage.write_version(rows, out, batch) and None).option("checkpointLocation", scratch(t.spark)).trigger(availableNow=True).start().awaitTermination()
    rows = replay.versions(t.spark, out)
    return rows.select(F.col("new")["id"].cast("long").alias("event_id"), "schema", "tbl", "op", F.to_json("old").alias("old"), F.to_json("new").alias("new"))


@query(f"""with f as ({feeds._FEED} where event_id > 200), h as (select id, arg_max(op, event_id) as last_op, max(event_id) as last_seq from f group by id)
select h.id, last_op, last_seq, c_name, (last_op = 'delete' or c_custkey is null) as deleted from h left join customer on id = c_custkey""")
def cdc_document_log(t: Tables):
    """A document log from a position on: changed documents as they are now, or deletes; the last batch that has an id counts."""
    log = t.events.select(F.col("event_id").alias("position"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "error", "d").otherwise("u").alias("op"), F.lit("app.events").alias("ns"), F.col("user_id").cast("string").alias("id"))
    path, root = _files(t, log), scratch(t.spark)
    customers = t.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    stream = replay.document_log(t.spark, path, 200, "ns = 'app.events'", stream=True, files=2)
    replay.tail(stream, lambda _: customers, root, scratch(t.spark)).awaitTermination()
    rows = replay.versions(t.spark, root)
    last = rows.groupBy("id").agg(F.max_by(F.struct("last_op", "last_seq", "c_name", "deleted"), "last_seq").alias("r"))
    return last.select(F.col("id").cast("long").alias("id"), "r.*")


def _cents():
    return F.round(F.col("value") * 100).cast("long")


_CENTS = "cast(round(value * 100) as bigint)"


def _event_stream(t: Tables, rows):
    path, last = scratch(t.spark), rows.agg(F.max("seq")).first()[0]
    for k in range(3):  # files in order of arrival
        rows.where((F.col("seq") * 3 > k * last) & (F.col("seq") * 3 <= (k + 1) * last) | (F.col("seq") <= 0) & F.lit(k == 0)).coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _aggregated(t: Tables):
    rows = t.events.select(F.col("user_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), _cents().alias("v"))
    root = scratch(t.spark)
    S.aggregator(_event_stream(t, rows), root, scratch(t.spark), ["daily", "alltime"], "v", "ts", "seq").awaitTermination()
    store = S.Store(t.spark, root)
    return store.read(store.version())


@query(f"""with x as (select user_id::varchar as id, 'daily' as category, strftime(ts, '%Y-%m-%d') as bucket, * exclude (user_id) from events union all select user_id::varchar, 'alltime', 'all', * exclude (user_id) from events)
select id, category, bucket, count(*) as count, sum({_CENTS})::bigint as sum, min({_CENTS}) as min, max({_CENTS}) as max, arg_min({_CENTS}, struct_pack(a := ts, b := event_id)) as first, arg_max({_CENTS}, struct_pack(a := ts, b := -event_id)) as last from x group by 1, 2, 3""")
def stream_aggregate(t: Tables):
    """The aggregator over a stream of files, in several micro-batches."""
    return A.current(_aggregated(t))


@query("""select user_id::varchar as id, 'all' as bucket, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_date, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_date from events group by 1""")
def stream_aggregate_meta(t: Tables):
    rows = A.meta(_aggregated(t)).where("category = 'alltime'")
    return rows.select("id", "bucket", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_date", "last_date")])


@query(f"""select user_id::varchar as id, strftime(ts, '%Y-%m-%d') as bucket, count(*) as count, sum({_CENTS})::bigint as sum from events where event_id % 3 <> 0 group by 1, 2""")
def agg_previous(t: Tables):
    """What a merged state was before its last batch."""
    rows = A.with_buckets(t.events.select(F.col("user_id").cast("string").alias("id"), "ts", "event_id", _cents().alias("v")), "ts", ["daily"])
    one, two = (A.partial(rows.where(c), "v", "ts", "event_id") for c in ("event_id % 3 <> 0", "event_id % 3 = 0"))
    return A.previous(A.merged(one, two)).where("count is not null").select("id", "bucket", "count", "sum")


@query(f"""select user_id, to_json(struct_pack(total := sum({_CENTS})::bigint, spent := struct_pack(most := max({_CENTS}) filter (where event_type = 'purchase'), n := count(*) filter (where event_type = 'purchase'))))::varchar as tree
from events where user_id in (select user_id from events where event_type = 'purchase') group by 1""")
def agg_nested(t: Tables):
    """Aggregates within aggregates."""
    bought = F.col("event_type") == "purchase"
    rows = t.events.join(t.events.where(bought).select("user_id").distinct(), "user_id", "left_semi")
    plan = {"total": F.sum(_cents()), "spent": {"most": F.max(F.when(bought, _cents())), "n": F.count_if(bought)}}
    return rows.groupBy("user_id").agg(*A.tree(plan)).select("user_id", F.to_json(F.struct("total", "spent")).alias("tree"))


@query("""select user_id as id, arg_max(event_type, event_id) as event_type from events where user_id is not null group by 1""")
def stream_entity_load(t: Tables):
    """A queue of records into an entity table, batch after batch; the last write wins."""
    rows = t.events.select(F.col("event_id").alias("seq"), F.col("user_id").alias("key"), "event_type")
    root = scratch(t.spark)
    S.load_from_queue(_event_stream(t, rows), root, scratch(t.spark), "user", "key", "seq").awaitTermination()
    store = S.Store(t.spark, f"{root}/records")
    return store.read(store.version()).select("id", "event_type")


@query("select event_id::varchar as position, event_type as v from events where lpad(event_id::varchar, 9, '0') > '000000100'")
def stream_queue(t: Tables):
    """A queue of files from a position on."""
    rows = t.events.select(F.lpad(F.col("event_id").cast("string"), 9, "0").alias("position"), F.col("event_type").alias("v"))
    out = scratch(t.spark)
    stream = S.queue(t.spark, _files(t, rows), "position string, v string", "000000100", 2)
    stream.writeStream.foreachBatch(lambda df, batch: storage.write_version(df, out, batch) and None).option("checkpointLocation", scratch(t.spark)).trigger(availableNow=True).start().awaitTermination()
    return replay.versions(t.spark, out).select(F.col("position").cast("long").cast("string").alias("position"), "v")


@query("""with w as (select time_bucket(interval '6 hours', ts, timestamp '2024-01-01') as s, count(*) as n from events group by 1)
select strftime(s, '%Y-%m-%d %H:%M:%S') as start, n from w where s + interval '6 hours' <= (select max(ts) from events) - interval '10 minutes'""")
def stream_windows(t: Tables):
    """Windows of event time that the watermark has closed."""
    rows = t.events.select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"))
    path, out = scratch(t.spark), scratch(t.spark)
    rows.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(path)
    stream = S.windowed(t.spark.readStream.schema(rows.schema).parquet(path), "ts", "6 hours")
    stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", scratch(t.spark)).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("""select event_id, lag(event_type) over w as old, event_type as new, case when user_id % 3 = 0 then 'q-customer' when user_id % 3 = 1 then 'q-order' else 'rest' end as queue from events where user_id is not null window w as (partition by user_id order by event_id)""")
def entity_images(t: Tables):
    """Stored images, some compressed, paired with the one before and routed by partition."""
    kind = F.when(F.col("user_id") % 3 == 0, "customer").when(F.col("user_id") % 3 == 1, "order").otherwise("none")
    rows = t.events.where("user_id is not null").select("user_id", "event_id", F.when(F.col("event_id") % 2 == 0, deflate("event_type")).otherwise(F.col("event_type")).alias("image"), F.concat(kind, F.lit("-3")).alias("p"))
    return C.processed(rows, "user_id", "event_id", "image", F.col("p"), {"customer": "q-customer", "order": "q-order"}, "rest").drop("user_id")


@query("""with f as (select case when event_type = 'error' then 'delete' else 'update' end as op, event_type as "table", user_id from events where user_id is not null)
select op, "table", count(distinct user_id) as ids from f group by 1, 2""")
def cdc_fold_pages(t: Tables):
    """Ids in pages of bounded size, each id in one page."""
    paged = C.fold_pages(feeds._feed(t).where("id is not null"), ["id"], 50)
    return paged.groupBy("op", "table").agg(F.sum(F.size("ids")).cast("long").alias("ids"))


@query("select event_id, event_type || event_id as text from events")
def text_compression(t: Tables):
    return t.events.select("event_id", inflate(deflate(F.concat("event_type", F.col("event_id").cast("string")))).alias("text"))


@query("select event_id, strftime(ts, '%Y-%m-%d') as day, case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') when event_id % 3 = 0 then strftime(ts, '%Y-%m-%d') || ' 00:00:00' end as found from events")
def iso_dates(t: Tables):
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.concat(F.lit("no date "), F.date_format("ts", "yyyy-MM-dd")))
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format(iso_time(text), "yyyy-MM-dd HH:mm:ss").alias("found"))


@query("select doc_id, nullif(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '') as text from documents")
def line_ends(t: Tables):
    return t.documents.select("doc_id", for_load(F.col("text")).alias("text"))


@query("select event_id, case when event_id % 2 = 0 then '{\"a\":\"' || event_type || '\",\"b\":\"' || user_id || '\"}' else '{\"b\":\"' || user_id || '\",\"a\":\"new\"}' end as image from events where user_id is not null")
def merged_images(t: Tables):
    """The new image's values over the old one's."""
    old = F.create_map(F.lit("a"), F.col("event_type"), F.lit("b"), F.col("user_id").cast("string"))
    new = F.when(F.col("event_id") % 2 == 1, F.create_map(F.lit("a"), F.lit("new")))
    return t.events.where("user_id is not null").select("event_id", F.to_json(C.merge_images(old, new)).alias("image"))


@query("select o_orderkey, datediff('day', date '1400-01-01', o_orderdate::date)::bigint + 10000 as d_order_date, (hour(o_orderdate) * 3600 + minute(o_orderdate) * 60 + 10000)::bigint as dim_order_time from orders")
def key_columns(t: Tables):
    """Key columns under their usual name and under a caller's own."""
    own = lambda c: "dim_" + c.removesuffix("_id")
    at = F.col("o_orderdate").cast("timestamp")
    return t.orders.select("o_orderkey", date_key(at).alias(fk_column("order_id") + "_date"), time_key(at).alias(own("order_id") + "_time"))


@query("select c_custkey, c_name, case when c_custkey % 2 = 0 then 'x' else c_mktsegment end as segment from customer")
def nested_merge(t: Tables):
    """Struct merged into struct: nulls keep what was there."""
    old = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    new = F.struct(F.lit(None).cast("string").alias("name"), F.when(F.col("c_custkey") % 2 == 0, "x").alias("segment"))
    rows = t.customer.select("c_custkey", old.alias("o"), new.alias("n"))
    return rows.select("c_custkey", merged(F.col("o"), F.col("n"), rows.schema["o"].dataType).alias("m")).select("c_custkey", F.col("m.name").alias("c_name"), F.col("m.segment").alias("segment"))
