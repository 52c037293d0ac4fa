"""Reconciling a copy of a table (slave) with its source (master).

Instead of walking ranges one after another, both sides are hashed once, summed per bucket of ids, and only buckets whose
sums differ are compared row by row. Rows are compared in one aggregate by id over both sides, which needs no join.

Ids may be numbers or texts. All rows with one id are compared as a whole, in whatever order they stand, so a repeated id
is correct where both sides repeat it alike; rows without an id are one such id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions.hashing import canonical, checksum_of, row_hash, widened, word
from tallyweave.session import cut, tasks

SUMS = [f"sum{k}" for k in range(1, 5)]


def individual(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(id, hash) of each row."""
    return df.select(F.col(key).alias("id"), row_hash(df, fields).alias("hash"))


def batch(df: DataFrame, key: str, fields: list[str], by: Column | None = None) -> DataFrame:
    """Quantity and word sums of the whole table, or of each bucket."""
    hashed = df.select(*([by.alias("bucket")] if by is not None else []), row_hash(df, fields).alias("hash"))
    if by is not None:
        return hashed.groupBy("bucket").agg(*checksum_of())
    # long sums within partitions, decimals over the few that are left
    return hashed.groupBy(F.spark_partition_id().alias("__part")).agg(*checksum_of()).agg(*widened())


def id_range(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Least and greatest id, and the number of ids."""
    rows = df if where is None else df.where(where)
    return rows.agg(F.min(key).alias("min"), F.max(key).alias("max"), F.count(key).alias("total"))


def composite_range(df: DataFrame, keys: list[str]) -> DataFrame:
    """Least and greatest key tuple, compared from the left."""
    tuple_ = F.struct(*keys)
    ends = df.agg(F.min(tuple_).alias("lo"), F.max(tuple_).alias("hi"), F.count(F.lit(1)).alias("total"))
    return ends.select(*[F.col(f"lo.{k}").alias(f"min_{k}") for k in keys], *[F.col(f"hi.{k}").alias(f"max_{k}") for k in keys], "total")


def bucket_of(key: Column, width: int) -> Column:
    """Buckets of number ids by value, exact for all longs: no order of all rows is needed for them."""
    whole = key.cast("long")
    return ((whole - F.pmod(whole, F.lit(width))).cast("decimal(20,0)") / F.lit(width).cast("decimal(20,0)")).cast("long")


#: Hash buckets of text ids: the first four hexadecimal digits of the md5.
TEXT_BUCKETS = 1 << 16


def buckets_by(df: DataFrame, key: str, width: int) -> Column:
    """The bucket of each row: by value for numbers, by hash for all else; null ids have none and stay together."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return bucket_of(F.col(key), width)
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("long")


def nibbles(df: DataFrame, key: str, limit: int, parts: int | None = None) -> DataFrame:
    """(bucket, start, end, qty) for pages of `limit` rows in id order, each page as a range.

    Ids are dealt into `parts` ranges (None: as many as the session's shuffles have), and numbered within each part after those of the parts before: however sparse they are, the one
    window over all has a row for each part only.
    """
    rows = cut(df.select(F.col(key).alias("id")).repartitionByRange(parts or tasks(df.sparkSession), "id").withColumn("__part", F.spark_partition_id()))
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__part").orderBy("id")
    numbered = rows.join(F.broadcast(before), "__part").select("id", bucket_of(F.col("__before") + F.row_number().over(own) - 1, limit).alias("bucket"))
    return numbered.groupBy("bucket").agg(F.min("id").alias("start"), F.max("id").alias("end"), F.count(F.lit(1)).alias("qty"))


def nibble(df: DataFrame, keys: list[str], limit: int, start: tuple | None = None, end: tuple | None = None, reverse: bool = False) -> DataFrame:
    """The last key of a page of `limit` rows and the first of the next, from a start on."""
    tuple_ = F.struct(*keys)
    rows = df
    bound = lambda values: F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, values)])
    if start is not None:
        rows = rows.where(tuple_ >= bound(start))
    if end is not None:
        rows = rows.where(tuple_ <= bound(end))
    order = [F.col(k).desc() if reverse else F.col(k).asc() for k in keys]
    return rows.select(*keys).orderBy(*order).offset(limit - 1).limit(2)


def compare_batches(master: DataFrame, slave: DataFrame) -> DataFrame:
    """Buckets whose sums differ, and how: the slave has too few rows, too many, or others."""
    m, s = master.select("bucket", F.col("qty").alias("m_qty"), *[F.col(c).alias(f"m_{c}") for c in SUMS]), slave.select("bucket", F.col("qty").alias("s_qty"), *[F.col(c).alias(f"s_{c}") for c in SUMS])
    both = m.withColumnRenamed("bucket", "m_bucket").join(s.withColumnRenamed("bucket", "s_bucket"), F.col("m_bucket").eqNullSafe(F.col("s_bucket")), "full_outer").withColumn("bucket", F.coalesce("m_bucket", "s_bucket"))
    same = F.lit(True)
    for c in ("qty", *SUMS):
        same = same & F.col(f"m_{c}").eqNullSafe(F.col(f"s_{c}"))
    few, many = F.coalesce("m_qty", F.lit(0)), F.coalesce("s_qty", F.lit(0))
    return both.where(~same).select("bucket", few.alias("master_qty"), many.alias("slave_qty"), F.when(many < few, "too few").when(many > few, "too many").otherwise("mismatch").alias("reason"))


def classify(master: DataFrame, slave: DataFrame) -> DataFrame:
    """(id, status) of two (id, hash) tables: correct, incorrect, missing in the slave, or extra there."""
    side = lambda df, sign: df.select("id", F.lit(sign).alias("side"), *[(word(F.col("hash"), k) * sign).alias(f"w{k}") for k in range(4)])
    both = side(master, 1).union(side(slave, -1)).groupBy("id").agg(F.count_if(F.col("side") > 0).alias("m"), F.count_if(F.col("side") < 0).alias("s"), *[F.sum(f"w{k}").alias(f"w{k}") for k in range(4)])
    equal = (F.col("m") == F.col("s")) & (F.col("w0") == 0) & (F.col("w1") == 0) & (F.col("w2") == 0) & (F.col("w3") == 0)
    return both.select("id", F.when(F.col("s") == 0, "missing").when(F.col("m") == 0, "extra").when(equal, "correct").otherwise("incorrect").alias("status"))


def diff(master: DataFrame, slave: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return classify(individual(master, key, fields), individual(slave, key, fields))


def drilldown(master: DataFrame, slave: DataFrame, key: str, fields: list[str], width: int = 1000) -> DataFrame:
    """The rows that are not correct, looking closely only at buckets whose sums differ.

    Buckets of numbers are ranges, so the least and greatest id of all that differ go to the scans, where row groups
    outside are never read."""
    left, right = buckets_by(master, key, width), buckets_by(slave, key, width)
    bad = cut(compare_batches(batch(master, key, fields, left), batch(slave, key, fields, right)).select("bucket"))
    if isinstance(master.schema[key].dataType, T.IntegralType):
        ends = bad.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"), F.count_if(F.col("bucket").isNull()).alias("nulls")).first()
        if ends["lo"] is not None:
            inside = F.col(key).between(ends["lo"] * width, ends["hi"] * width + width - 1)
            inside = inside | F.col(key).isNull() if ends["nulls"] else inside
            master, slave = master.where(inside), slave.where(inside)
    pick = lambda df, by: df.withColumn("__bucket", by).join(bad, F.col("__bucket").eqNullSafe(F.col("bucket")), "left_semi")
    return diff(pick(master, left), pick(slave, right), key, fields).where("status <> 'correct'")


def totals(statuses: DataFrame) -> DataFrame:
    """One row with the number of each status."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return statuses.agg(count("correct"), count("incorrect"), count("missing"), count("extra"))


def sample(statuses: DataFrame, seed: int, size: int = 4) -> DataFrame:
    """Some ids of each status that is not correct, the same ones for a seed."""
    order = Window.partitionBy("status").orderBy(F.xxhash64("id", F.lit(seed)), "id")
    return statuses.where("status <> 'correct'").withColumn("n", F.row_number().over(order)).where(F.col("n") <= size).drop("n")


def field_differences(master: DataFrame, slave: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(id, field, master, slave) for each field that differs in rows both sides have."""
    m = master.select(F.col(key).alias("id"), F.array(*[F.struct(F.lit(f).alias("field"), canonical(master, f).alias("value")) for f in fields]).alias("m"))
    s = slave.select(F.col(key).alias("id"), F.array(*[canonical(slave, f) for f in fields]).alias("s"))
    pairs = m.join(s, "id").select("id", F.explode(F.zip_with("m", "s", lambda a, b: F.struct(a["field"].alias("field"), a["value"].alias("master"), b.alias("slave")))).alias("p"))
    return pairs.where(~F.col("p.master").eqNullSafe(F.col("p.slave"))).select("id", "p.field", "p.master", "p.slave")


def prune(slave: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """The slave without rows that the master lacks."""
    return slave.join(master.select(key), key, "left_semi")


def delete_ids(df: DataFrame, key: str, ids: DataFrame | None = None, start=None, end=None, not_ids: DataFrame | None = None, soft: str | None = None) -> DataFrame:
    """Without ids, or without a range but for some ids; with `soft` rows are marked in that column instead."""
    if ids is not None:
        hit = df.join(ids.select(F.col(key), F.lit(True).alias("__hit")).distinct(), key, "left")
    else:
        kept = not_ids.select(F.col(key), F.lit(False).alias("__not")).distinct() if not_ids is not None else df.sparkSession.createDataFrame([], df.select(key).schema).withColumn("__not", F.lit(False))
        inside = (F.col(key) >= start if start is not None else F.lit(True)) & (F.col(key) <= end if end is not None else F.lit(True))
        hit = df.join(kept, key, "left").withColumn("__hit", inside & F.col("__not").isNull()).drop("__not")
    gone = F.coalesce("__hit", F.lit(False))
    if soft:
        old = F.coalesce(F.col(soft), F.lit(False)) if soft in df.columns else F.lit(False)
        return hit.withColumn(soft, old | gone).drop("__hit")
    return hit.where(~gone).select(*df.columns)


def delete_by(df: DataFrame, field: str, ids: DataFrame) -> DataFrame:
    """Without the rows whose `field` is among `ids` (its first column), of any number."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(field)).distinct(), field, "left_anti").select(*df.columns)


def reconcile(master: DataFrame, slave: DataFrame, key: str, fields: list[str], transform: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(totals, what differs), the latter through a transform if given, as a queue would get it."""
    statuses = diff(master, slave, key, fields)
    found = statuses.where("status <> 'correct'")
    return totals(statuses), transform(found) if transform else found
