"""The documented small example, and properties."""

from pyspark.sql import functions as F

from tallyweave.operators import reconcile as R
from tallyweave.sources.adapters import CustomAdapter, MockAdapter, TableAdapter, compare


def test_many_extra_rows(spark):
    master = spark.createDataFrame([(1, "a"), (2, "b"), (10_000_000, "c")], "id long, data string")
    slave = spark.createDataFrame([(1, "a"), *[(i, None) for i in range(2, 102)], (1_000_000, None), (10_000_000, "c")], "id long, data string")
    found = R.totals(R.diff(master, slave, "id", ["data"])).first()
    assert (found.correct, found.incorrect, found.missing, found.extra) == (2, 1, 0, 100)
    assert R.prune(slave, master, "id").count() == 3


def test_equal_tables_are_correct_and_sums_ignore_order(spark):
    rows = spark.range(1000).withColumn("v", F.col("id") * 7)
    assert R.totals(R.diff(rows, rows, "id", ["v"])).first().correct == 1000
    assert R.batch(rows, "id", ["v"]).collect() == R.batch(rows.orderBy(F.desc("id")), "id", ["v"]).collect()
    assert R.drilldown(rows, rows, "id", ["v"]).isEmpty()


def test_null_and_blank_fields_do_not_collide(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "", "a")], "id int, x string, y string")
    assert R.individual(rows, "id", ["x", "y"]).select("hash").distinct().count() == 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, v string")
    assert R.totals(R.diff(none, none, "id", ["v"])).first().correct == 0
    assert R.nibbles(none, "id", 10).isEmpty()
    assert R.batch(none, "id", ["v"]).first().qty == 0


def test_sample_is_stable_and_bounded(spark):
    statuses = spark.range(100).select("id", F.lit("extra").alias("status"))
    assert R.sample(statuses, 1).count() == 4
    assert sorted(R.sample(statuses, 1).collect()) == sorted(R.sample(statuses, 1).collect())


def test_adapters(spark):
    good, bad = MockAdapter(spark, 50), MockAdapter(spark, 50, wrong_every=10)
    assert {r["status"]: r["count"] for r in compare(good, bad).groupBy("status").count().collect()} == {"correct": 45, "incorrect": 5}
    assert good.handle("range").first() == (1, 50, 50)
    assert [r[0] for r in good.handle("nibble", limit=10).collect()] == [10, 11]
    assert [r[0] for r in good.nibble(10, reverse=True).collect()] == [41, 40]
    assert good.sample([3, 1]).count() == 2
    table = TableAdapter(spark, good.load(), "id", ["value"])
    assert table.delete(table.load().where("id < 11")).count() == 40
    own = CustomAdapter(spark, "id", ["value"], good.load, range=lambda **_: "mine")
    assert own.handle("range") == "mine"
    try:
        good.handle("drop")
    except ValueError as problem:
        assert "Invalid Method" in str(problem)
    else:
        raise AssertionError
