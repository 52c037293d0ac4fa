"""Facts, slowly changing dimensions, validation and links on small fixed rows."""

from pyspark.sql import functions as F

from tallyweave.functions.validation import Field, Table, bad_deletes, split
from tallyweave.operators import warehouse as W

AUDIT = "2020-01-01 00:00:00"
PRESENTERS = Table(
    "d_presenters",
    (Field("d_id", "bigint", sk=True), Field("id", "bigint", nk=True), Field("name"), Field("scd1", scd=1), Field("something", scd=1), Field("scd2", scd=2), Field("scd3", scd=3)),
    True,
)


def presenters(spark):
    rows = [(100000 + i, i, f"name {i}", "one", "x", "two", "three") for i in range(1, 8)]
    dim = spark.createDataFrame(rows, "d_id long, id long, name string, scd1 string, something string, scd2 string, scd3 string")
    return dim.withColumn("previous_scd3", F.lit(None).cast("string")).withColumn("_auditdate", F.lit("2019-01-01").cast("timestamp")).withColumn("_startdate", F.lit(W.START).cast("timestamp")).withColumn("_enddate", F.lit(W.END).cast("timestamp")).withColumn("_current", F.lit(True))


def invariants(dim):
    current = dim.where("_current").groupBy("id").count()
    assert current.where("count <> 1").isEmpty()
    assert dim.select("d_id").distinct().count() == dim.count()


def test_fact_update_keeps_missing_columns(spark):
    base = spark.createDataFrame([(i, 14500, 13140) for i in (1, 2, 3)], "id long, cost long, taxes long")
    fact = W.fact_upsert(base.limit(0), base, ["id"], AUDIT)
    staged = spark.createDataFrame([(1, None, 13140), (2, None, 13340), (3, None, 23140), (4, 14500, 13140)], "id long, cost long, taxes long")
    after = W.fact_upsert(fact, staged, ["id"], AUDIT)
    assert [(r.id, r.cost, r.taxes, r._deleted) for r in after.orderBy("id").collect()] == [(1, 14500, 13140, False), (2, 14500, 13340, False), (3, 14500, 23140, False), (4, 14500, 13140, False)]
    assert sorted(W.fact_upsert(after, staged, ["id"], AUDIT).collect()) == sorted(after.collect())


def test_type_1(spark):
    staged = spark.createDataFrame([(i, "new", "y") for i in range(1, 9)], "id long, scd1 string, something string")
    after = W.scd_load(presenters(spark), staged, PRESENTERS, AUDIT)
    assert after.count() == 8 and after.where("scd1 = 'new'").count() == 8
    assert str(after.where("id = 8").first()._startdate).startswith("1900")
    invariants(after)


def test_type_2(spark):
    staged = spark.createDataFrame([(i, "changed") for i in range(1, 9)], "id long, scd2 string")
    after = W.scd_load(presenters(spark), staged, PRESENTERS, AUDIT)
    assert after.count() == 15 and after.where("not _current").count() == 7
    assert after.where("not _current and _enddate <> timestamp '2020-01-01'").isEmpty()
    invariants(after)
    again = W.scd_load(after, staged, PRESENTERS, "2021-01-01 00:00:00")
    assert again.count() == 15


def test_mixed_types(spark):
    rows = [(1, "one", "two", "three"), (2, "n1", "n2", "n3"), (3, "one", "n2", "n3"), (4, "n1", "two", "n3"), (5, "n1", "n2", "three"), (6, "one", "two", "three"), (7, "one", "two", "three"), (8, "a", "b", "c")]
    after = W.scd_load(presenters(spark), spark.createDataFrame(rows, "id long, scd1 string, scd2 string, scd3 string"), PRESENTERS, AUDIT)
    assert after.count() == 11
    assert {r.id for r in after.where("not _current").collect()} == {2, 3, 5}
    assert after.where("id in (2, 4, 5) and scd1 <> 'n1'").isEmpty()
    now = {r.id: r for r in after.where("_current").collect()}
    assert [(i, now[i].scd3, now[i].previous_scd3) for i in (2, 3, 4, 5)] == [(2, "n3", "three"), (3, "n3", "three"), (4, "n3", "three"), (5, "three", None)]
    assert after.where("not _current and scd3 <> 'three'").isEmpty()
    assert all(str(now[i]._auditdate).startswith("2019") for i in (1, 6, 7))
    invariants(after)


def test_fold_with_delete_between(spark):
    events = spark.createDataFrame([(1, 1, "a", None, False), (1, 2, None, "b", False), (2, 3, "c", "d", False), (2, 4, None, None, True), (3, 5, "e", "f", True), (3, 6, "g", None, False)], "id int, seq int, x string, y string, gone boolean")
    found = {r.id: (r.x, r.y, r._deleted) for r in W.fold(events, ["id"], "seq", ["x", "y"], "gone").collect()}
    assert found == {1: ("a", "b", False), 2: (None, None, True), 3: ("g", None, False)}


def test_validation(spark):
    spec = Table("f", (Field("id", "bigint", nk=True), Field("s", "varchar(3)"), Field("e", values=("x", "y")), Field("n", "integer"), Field("f", "float"), Field("t", "timestamp")))
    rows = [("1", "abc", "x", "5", "1.5", "2020-01-01"), (None, "a", "x", "1", "1", None), ("2", "abcd", "z", "3000000000", "q", "never"), ("99999999999999999999", None, None, "1.5", None, None)]
    good, bad = split(spark.createDataFrame(rows, "id string, s string, e string, n string, f string, t string"), spec)
    assert [r.id for r in good.collect()] == ["1"]
    assert sorted(len(r.errors) for r in bad.collect()) == [1, 2, 5]
    good, bad = split(spark.createDataFrame([(1, "u")], "id int, extra string"), spec)
    assert good.isEmpty() and bad.count() == 1
    assert bad_deletes(spark.createDataFrame([([], ["a"]), ([1], ["a"]), (None, ["a"])], "ids array<int>, entities array<string>")).count() == 2


def test_links_use_half_open_versions(spark):
    dim = spark.createDataFrame([(10, 1, "1900-01-01", "2020-01-01", False), (11, 1, "2020-01-01", "9999-01-01", True)], "sk long, id int, s string, e string, _current boolean").select("sk", "id", F.col("s").cast("timestamp").alias("_startdate"), F.col("e").cast("timestamp").alias("_enddate"), "_current")
    fact = spark.createDataFrame([(1, "2019-12-31"), (1, "2020-01-01"), (2, "2020-01-01"), (None, "2020-01-01")], "id int, at string").withColumn("at", F.col("at").cast("timestamp"))
    assert sorted(r.k for r in W.link(fact, dim, {"id": "id"}, "sk", "at", "k").collect()) == [1, 1, 10, 11]


def test_new_table_has_the_unknown_member(spark):
    row = W.create_table(spark, PRESENTERS).first()
    assert row.d_id == 1 and row._current
    assert W.create_table(spark, Table("f", (Field("id", "bigint", nk=True),))).isEmpty()
