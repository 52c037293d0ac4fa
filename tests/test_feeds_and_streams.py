"""Parsers, sources, sinks, and streams against their batch results."""

import json

from pyspark.sql import functions as F

from tallyweave.functions.scalars import bucket_label, column_name, deflate, hash31, inflate, lsn_next, table_name
from tallyweave.operators import aggregates as A
from tallyweave.operators import changes as C
from tallyweave.operators import domain as D
from tallyweave.operators import entity as E
from tallyweave.sources import files, http
from tallyweave.streaming import aggregator as S


def test_logical_decoding_lines():
    insert = C.decode_line("table public.t: INSERT: id[integer]:1 name[character varying]:'it''s, ok' \"Odd One\"[text[]]:null f[double precision]:1.5")
    assert (insert["op"], insert["new"]) == ("INSERT", {"id": "1", "name": "it's, ok", "Odd One": None, "f": "1.5"})
    update = C.decode_line("table \"My.S\".\"T:x\": UPDATE: old-key: id[integer]:1 new-tuple: id[integer]:2 v[text]:'a\nb'")
    assert (update["schema"], update["tbl"], update["old"], update["new"]) == ("My.S", "T:x", {"id": "1"}, {"id": "2", "v": "a\nb"})
    assert C.decode_line("BEGIN 12")["xid"] == 12
    assert C.decode_line("COMMIT 12 (at 2020-01-01 00:00:00+00)")["time"].startswith("2020")
    assert C.decode_line("table public.t: DELETE: (no-tuple-data)")["new"] == {}
    assert C.decode_line("nonsense")["kind"] == "unreadable"


def test_scalars(spark):
    row = spark.sql("select 'A/FFFFFFFF' as lsn, 'abc' as s, 'zürich' as u, timestamp '2024-12-30 01:02:03' as t").select(lsn_next(F.col("lsn")), hash31(F.col("s")), hash31(F.col("u")), bucket_label(F.col("t"), "weekly"), bucket_label(F.col("t"), "quarterly"), bucket_label(F.col("t"), ""), inflate(deflate("s"))).first()

    def plain(s):
        h = 0
        for ch in s:
            h = (h * 31 + ord(ch) + 2**31) % 2**32 - 2**31
        return h

    assert tuple(row) == ("B/0", plain("abc"), plain("zürich"), "2024-1", "2024-4", "all", "abc")
    assert (table_name("OrderItem", False), column_name("Ts:created"), column_name("Ref:Owner"), column_name("A b")) == ("f_order_item", "created_ts", "owner_id", "a_b")


def test_merge_images_and_history(spark):
    row = spark.sql("select map('a','1','b','2') o, map('b','3') n").select(C.merge_images(F.col("o"), F.col("n")).alias("m")).first()
    assert row.m == {"a": "1", "b": "3"}
    routed = C.route(spark.createDataFrame([("order-3",), ("big-order-1",), ("x",)], "p string"), F.col("p"), {"order": "q1", "big-order": "q2"}, "rest")
    assert [r.queue for r in routed.collect()] == ["q1", "q2", "rest"]


def test_scroll_and_bulk():
    pages = [{"hits": {"hits": [{"_id": str(i), "_source": {"v": i}} for i in range(k, k + 3)]}, "_scroll_id": "s"} for k in (0, 3)] + [{"hits": {"hits": []}}]
    answers = iter(pages)
    assert [i for i, _ in http.scroll(lambda url, body: next(answers), "u", {}, 3, 100)] == list("012345")
    answers = iter(pages)
    assert len(list(http.scroll(lambda url, body: next(answers), "u", {}, 3, 4))) == 4

    class Row(dict):
        def asDict(self, deep):
            return dict(self)

    lines = "".join(http.bulk_lines(iter([Row(id=1, v=2), Row(id=2, deleted=True)]), "ix")).splitlines()
    assert [next(iter(json.loads(x))) for x in lines] == ["update", "doc", "delete"]


def test_copy_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a|b\nc"), (2, None), (3, "")], "id int, s string")
    files.copy_out(rows, str(tmp_path / "x"))
    back = {r.id: r.s for r in files.copy_in(spark, str(tmp_path / "x"), "id int, s string").collect()}
    assert back[1] == "a|b\\nc" and back[2] is None and back[3] is None


def test_publish_and_snapshot(spark, tmp_path):
    files.publish(spark.range(3).toDF("id"), str(tmp_path / "t"), 1)
    files.publish(spark.range(5).toDF("id"), str(tmp_path / "t"), 2)
    assert files.published(spark, str(tmp_path / "t")).count() == 5
    pages = D.write_snapshot(spark.range(25).toDF("id"), "id", 10, str(tmp_path / "s"), done=[0])
    assert sorted(r.page for r in pages.collect()) == [1, 2]
    assert spark.read.json(str(tmp_path / "s")).count() == 15


def test_entity_load(spark):
    good, bad = E.load(spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string"), "thing", "k")
    assert good.count() == 1 and bad.count() == 1
    assert E.get(good, "thing", 1).first().v == "a"


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("user_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.round(F.col("value") * 100).cast("long").alias("v"))
    source = str(tmp_path / "in")
    for k in range(3):
        rows.where(f"seq % 3 = {k}").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    S.aggregator(stream, str(tmp_path / "state"), str(tmp_path / "cp"), ["daily", "alltime"], "v", "ts", "seq").awaitTermination()
    store = S.Store(spark, str(tmp_path / "state"))
    assert store.version() == 2
    found = A.current(store.read(2))
    whole = A.partial(A.with_buckets(rows, "ts", ["daily", "alltime"]), "v", "ts", "seq")
    expected = whole.select(*[F.col(c) for c in ("id", "category", "bucket", "count", "sum", "min", "max")], F.col("first.v").alias("first"), F.col("last.v").alias("last"))
    assert sorted(found.collect()) == sorted(expected.collect())
    held = sorted(found.collect())
    S.aggregate_batch(store, rows, 2, ["daily"], "v", "ts", "seq")
    assert sorted(A.current(store.read(2)).collect()) == held


def test_a_crash_between_state_and_manifest_loses_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(str(k), "2024-01-01", k, 1) for k in range(50)], "id string, ts string, seq long, v long").withColumn("ts", F.col("ts").cast("timestamp"))
    store = S.Store(spark, str(tmp_path / "s"), 4)
    S.aggregate_batch(store, rows, 0, ["daily"], "v", "ts", "seq")
    whole, write = S.Store.write, S.storage.write_version
    for broken in ("data", "manifest"):  # dies after part of the data, then before the manifest
        S.storage.write_version = lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed"))
        if broken == "data":
            S.Store.write = lambda self, df, batch, touched, key="id": df.limit(1).write.mode("overwrite").parquet(f"{self.root}/data/version-{batch}") or (_ for _ in ()).throw(RuntimeError("killed"))
        try:
            S.aggregate_batch(store, rows, 1, ["daily"], "v", "ts", "seq")
        except RuntimeError:
            pass
        finally:
            S.Store.write, S.storage.write_version = whole, write
        assert store.version() == 0 and {r["sum"] for r in A.current(store.read(0)).collect()} == {1}
    for batch in (1, 1, 2):
        S.aggregate_batch(store, rows, batch, ["daily"], "v", "ts", "seq")
    assert store.version() == 2 and {r["sum"] for r in A.current(store.read(2)).collect()} == {3}
    assert A.current(store.read(2)).count() == 50
    S.aggregate_batch(store, rows.where("id = '7'"), 3, ["daily"], "v", "ts", "seq")
    assert {r["id"]: r["sum"] for r in A.current(store.read(3)).collect()} == {str(k): 3 + (k == 7) for k in range(50)}


def test_queue_rows_without_key_are_quarantined(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("0001", 1, "a"), ("0002", None, "b"), ("0003", 1, "c"), ("0004", 2, "d")], "position string, k int, v string").coalesce(1).write.json(source)
    stream = S.queue(spark, source, "position string, k int, v string", "0001", 1)
    S.load_from_queue(stream, str(tmp_path / "t"), str(tmp_path / "cp"), "thing", "k", "position").awaitTermination()
    store = S.Store(spark, str(tmp_path / "t/records"))
    assert {(r.id, r.v) for r in store.read(store.version()).collect()} == {(1, "c"), (2, "d")}
    assert [r.v for r in spark.read.json(str(tmp_path / "t/thing_error/*")).collect()] == ["b"]


def test_streaming_change_counter(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "y", 3), ("a", "x", 4), ("b", "x", 5)], "id string, value string, seq long")
    source = str(tmp_path / "in")
    rows.where("seq < 3").coalesce(1).write.parquet(source)
    rows.where("seq >= 3").coalesce(1).write.mode("append").parquet(source)
    out = S.count_changes(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source))
    query = out.writeStream.format("memory").queryName("changes").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.id: r.changes for r in spark.table("changes").groupBy("id").agg(F.max("changes").alias("changes")).collect()} == {"a": 2, "b": 0}
