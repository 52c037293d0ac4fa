"""Feeding facts and slowly changing dimensions. Every function takes snapshots and gives the next snapshot.

`audit_ts` is always a parameter: a load run again with the same one gives the same tables. Surrogate keys of new
members are numbered by natural key within ranges of it, so no task has to order all of them.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions.nested import flat, nest
from tallyweave.functions.scalars import UNKNOWN_KEY, date_key, fk_column, time_key
from tallyweave.functions.validation import Table, spark_type
from tallyweave.session import cut, tasks

FIRST_KEY = 10000
START, END = "1900-01-01 00:00:00", "9999-01-01 00:00:00"


def _ts(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp")


def fold(events: DataFrame, keys: list[str], seq: str, columns: list[str], deleted: str | None = None) -> DataFrame:
    """One row for each key: each column's last value that is not null, counting from the last delete on.

    A key whose last event is a delete keeps only its key and `_deleted`; data after a delete is a new insert. Columns that
    are structs are folded field by field.
    """
    nested = T.StructType([f for f in events.schema.fields if f.name in columns])
    if any(isinstance(f.dataType, T.StructType) for f in nested.fields):
        rows, names = flat(events, columns)
        out = fold(rows, keys, seq, list(names.values()), deleted)
        return out.select(*keys, *nest(nested, names), *(["_deleted"] if deleted else []))
    rows = events
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    if deleted:
        last = rows.where(gone).groupBy(*keys).agg(F.max(seq).alias("__gone"))
        cond = reduce(lambda a, b: a & b, [F.col(f"e.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys])
        rows = rows.alias("e").join(last.alias("g"), cond, "left").select("e.*", "__gone").where(F.col("__gone").isNull() | (F.col(seq) >= F.col("__gone")))
    present = lambda c: F.col(c).isNotNull() & ~gone
    picked = [F.max_by(c, F.when(present(c), F.col(seq))).alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*picked, *([F.max_by(gone, seq).alias("_deleted")] if deleted else []))


def fact_upsert(fact: DataFrame, staged: DataFrame, keys: list[str], audit_ts: datetime | str, deleted: str | None = None) -> DataFrame:
    """Staged values over the fact's own, nulls and missing columns keeping them; unknown keys are inserted."""
    match = reduce(lambda a, b: a & b, [F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    both = fact.withColumn("__f", F.lit(True)).alias("f").join(staged.withColumn("__s", F.lit(True)).alias("s"), match, "full_outer")
    out = []
    for c in dict.fromkeys([*fact.columns, *staged.columns]):
        if c in ("_auditdate", "_deleted") or c.startswith("_") and c not in fact.columns or c == deleted:
            continue
        sides = [F.col(f"s.{c}")] * (c in staged.columns) + [F.col(f"f.{c}")] * (c in fact.columns)
        out.append(F.coalesce(*sides).alias(c))
    old = F.coalesce(F.col("f._deleted"), F.lit(False)) if "_deleted" in fact.columns else F.lit(False)
    gone = F.coalesce(F.col(f"s.{deleted}"), F.lit(False)) if deleted else F.lit(False)
    before = F.col("f._auditdate").cast("timestamp") if "_auditdate" in fact.columns else F.lit(None).cast("timestamp")
    return both.select(*out, F.when(F.col("s.__s"), _ts(audit_ts)).otherwise(before).alias("_auditdate"), (old | gone).alias("_deleted"))


def soft_delete_fact(fact: DataFrame, ids: DataFrame, key: str, audit_ts: datetime | str) -> DataFrame:
    """Rows of these ids marked as deleted."""
    hit = fact.join(ids.select(F.col(key)).distinct().withColumn("__hit", F.lit(True)), key, "left")
    rest = [c for c in fact.columns if c not in ("_deleted", "_auditdate")]
    old = F.coalesce(F.col("_deleted"), F.lit(False)) if "_deleted" in fact.columns else F.lit(False)
    audit = F.col("_auditdate") if "_auditdate" in fact.columns else F.lit(None).cast("timestamp")
    return hit.select(*rest, F.when(F.col("__hit"), _ts(audit_ts)).otherwise(audit).alias("_auditdate"), (old | F.coalesce("__hit", F.lit(False))).alias("_deleted"))


def soft_delete_dimension(dim: DataFrame, ids: DataFrame, key: str, audit_ts: datetime | str) -> DataFrame:
    """Current versions of these ids ended."""
    hit = dim.join(ids.select(F.col(key)).distinct().withColumn("__hit", F.lit(True)), key, "left")
    ends = F.coalesce("__hit", F.lit(False)) & F.col("_current")
    return hit.withColumn("_enddate", F.when(ends, _ts(audit_ts)).otherwise(F.col("_enddate"))).withColumn("_current", F.col("_current") & ~ends).select(*dim.columns)


def next_keys(rows: DataFrame, order: list[str], base: int, sk: str, parts: int | None = None) -> DataFrame:
    """`rows` with keys base+1, base+2, .. by the order of their natural keys.

    Numbers run within `parts` ranges of the order (None: as many as the session's shuffles have) and start after the ranges
    before, so that many tasks share the work; the result is the same for any number of them.
    """
    ranged = cut(rows.repartitionByRange(parts or tasks(rows.sparkSession), *order).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__part").orderBy(*order)
    return ranged.join(F.broadcast(before), "__part").withColumn(sk, (F.lit(base) + F.col("__before") + F.row_number().over(own)).cast("long")).select(*rows.columns, sk)


def max_key(dim: DataFrame, sk: str) -> int:
    return dim.agg(F.coalesce(F.max(sk), F.lit(FIRST_KEY)).alias("k")).first()["k"]


def scd_load(dim: DataFrame, staged: DataFrame, table: Table, audit_ts: datetime | str, parts: int | None = None) -> DataFrame:
    """The dimension after loading at most one staged row for each natural key.

    Values that are null or absent in staging stay as they are and are no change. Type 1 overwrites all versions; type 2
    ends the current version and adds one; type 3 moves the current value to previous_<column>; type 6 keeps
    current_<column> on all versions. A new member starts in 1900.
    """
    keys, sk = table.natural_key, table.surrogate_key
    groups = {n: [c for c in table.group(n) if c in dim.columns] for n in (1, 2, 3, 6)}
    attributes = [f.name for f in table.fields if f.name not in keys and f.name != sk and f.name in dim.columns]
    plain = [c for c in attributes if not any(c in g for g in groups.values())]
    match = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])

    current = dim.where("_current").withColumn("__known", F.lit(True))
    joined = staged.alias("s").join(current.alias("c"), match("s", "c"), "left")
    value = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"c.{c}")) if c in staged.columns else F.col(f"c.{c}")
    changed = lambda cols: reduce(lambda a, b: a | b, [~value(c).eqNullSafe(F.col(f"c.{c}")) for c in cols], F.lit(False))
    known = F.coalesce(F.col("c.__known"), F.lit(False))
    changes = joined.select(
        *[F.col(f"s.{k}").alias(k) for k in keys],
        *[value(c).alias(f"v_{c}") for c in attributes],
        *[F.col(f"c.{c}").alias(f"o_{c}") for c in groups[3]],
        (~known).alias("is_new"),
        (known & changed(groups[1] + plain)).alias("chg1"),
        (known & changed(groups[2])).alias("chg2"),
        (known & changed(groups[3])).alias("chg3"),
        (known & changed(groups[6])).alias("chg6"),
    ).where("is_new or chg1 or chg2 or chg3 or chg6")

    extra = [c for c in dim.columns if c not in keys and c not in attributes and c not in (sk, "_auditdate", "_startdate", "_enddate", "_current")]
    history = dim.alias("d").join(changes.alias("x"), match("d", "x"), "left")
    touched = F.coalesce(~F.col("x.is_new"), F.lit(False))
    closing = touched & F.coalesce(F.col("x.chg2"), F.lit(False)) & F.col("d._current")
    columns: dict[str, Column] = {c: F.col(f"d.{c}") for c in dim.columns}
    for c in groups[1] + plain:
        columns[c] = F.when(touched, F.col(f"x.v_{c}")).otherwise(F.col(f"d.{c}"))
    for c in groups[3]:
        # on the current row only, and not on one that is being ended: the new version carries the shift then
        shift = touched & F.col("d._current") & F.col("x.chg3") & ~closing
        columns[c] = F.when(shift, F.col(f"x.v_{c}")).otherwise(F.col(f"d.{c}"))
        if f"previous_{c}" in dim.columns:
            columns[f"previous_{c}"] = F.when(shift & ~F.col(f"x.v_{c}").eqNullSafe(F.col(f"x.o_{c}")), F.col(f"x.o_{c}")).otherwise(F.col(f"d.previous_{c}"))
    for c in groups[6]:
        if f"current_{c}" in dim.columns:
            columns[f"current_{c}"] = F.when(touched, F.col(f"x.v_{c}")).otherwise(F.col(f"d.current_{c}"))
    columns["_enddate"] = F.when(closing, _ts(audit_ts)).otherwise(F.col("d._enddate").cast("timestamp"))
    columns["_current"] = F.col("d._current") & ~closing
    columns["_auditdate"] = F.when(touched, _ts(audit_ts)).otherwise(F.col("d._auditdate").cast("timestamp"))
    old = history.select(*[columns[c].alias(c) for c in dim.columns])

    fresh = changes.where("is_new or chg2").alias("x").join(current.alias("c"), match("x", "c"), "left")
    new: dict[str, Column] = {k: F.col(f"x.{k}") for k in keys} | {c: F.col(f"x.v_{c}") for c in attributes}
    for c in extra:
        new[c] = F.col(f"c.{c}")
    for c in groups[3]:
        if f"previous_{c}" in dim.columns:
            new[f"previous_{c}"] = F.when(F.col("x.chg3"), F.col(f"x.o_{c}")).otherwise(F.col(f"c.previous_{c}"))
    for c in groups[6]:
        if f"current_{c}" in dim.columns:
            new[f"current_{c}"] = F.col(f"x.v_{c}")
    new |= {"_auditdate": _ts(audit_ts), "_startdate": F.when(F.col("x.is_new"), _ts(START)).otherwise(_ts(audit_ts)), "_enddate": _ts(END), "_current": F.lit(True)}
    rows = fresh.select(*[new[c].alias(c) for c in dim.columns if c != sk])
    rows = next_keys(rows, keys, max_key(dim, sk), sk, parts) if sk else rows
    return old.unionByName(rows.select(*dim.columns))


def missing_members(dim: DataFrame, fact: DataFrame, keys: dict[str, str], sk: str, audit_ts: datetime | str, parts: int | None = None) -> DataFrame:
    """The dimension with a placeholder for each key that facts have and it lacks. `keys` maps dimension to fact columns.

    Keys with a null part have no member: they link to the unknown one.
    """
    wanted = fact.select(*[F.col(f).alias(d) for d, f in keys.items()]).dropna(how="any").distinct()
    lacking = wanted.join(dim.select(*keys).distinct(), list(keys), "left_anti")
    fixed = {"_auditdate": _ts(audit_ts), "_startdate": _ts(START), "_enddate": _ts(END), "_current": F.lit(True)}
    rows = next_keys(lacking, list(keys), max_key(dim, sk), sk, parts)
    return dim.unionByName(rows.select(*[F.col(c) if c in keys or c == sk else fixed[c].alias(c) if c in fixed else F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in dim.columns]))


def link(fact: DataFrame, dim: DataFrame, on: dict[str, str], sk: str, link_ts: str, column: str) -> DataFrame:
    """`fact` with the surrogate key of the version that was valid at `link_ts`, 1 where there is none.

    Versions hold from their start up to their end; the current one has no end. `on` maps fact to dimension columns.
    The condition keeps the equality first, so it is planned as an equi-join with the range as a filter.
    """
    cond = reduce(lambda a, b: a & b, [F.col(f"f.{a}") == F.col(f"d.{b}") for a, b in on.items()])
    at = F.col(f"f.{link_ts}").cast("timestamp")
    cond = cond & (at >= F.col("d._startdate")) & ((at < F.col("d._enddate")) | F.col("d._current"))
    versions = dim.select(*dict.fromkeys([*on.values(), sk, "_startdate", "_enddate", "_current"]))
    return fact.alias("f").join(versions.alias("d"), cond, "left").select("f.*", F.coalesce(F.col(f"d.{sk}"), F.lit(UNKNOWN_KEY)).cast("long").alias(column))


def date_keys(fact: DataFrame, columns: list[str], with_time: bool = True) -> DataFrame:
    """Date and time keys of timestamp columns."""
    for c in columns:
        fact = fact.withColumn(f"{fk_column(c)}_date", date_key(F.col(c)))
        if with_time:
            fact = fact.withColumn(f"{fk_column(c)}_time", time_key(F.col(c)))
    return fact


def unknown_member(spark, table: Table, audit_ts: datetime | str) -> DataFrame:
    """The one row with key 1 that a new dimension starts with."""
    fixed = {"_auditdate": _ts(audit_ts), "_startdate": _ts(START), "_enddate": _ts(END), "_current": F.lit(True), table.surrogate_key: F.lit(UNKNOWN_KEY)}
    return spark.range(1).select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema()])


def create_table(spark, table: Table, audit_ts: datetime | str = START) -> DataFrame:
    return unknown_member(spark, table, audit_ts) if table.is_dimension and table.surrogate_key else spark.createDataFrame([], table.schema())


def evolve(df: DataFrame | None, wanted: T.StructType | Table, spark=None) -> tuple[DataFrame, str]:
    """(table with the columns it lacked, Unmodified, Modified or Created). Columns are only ever added."""
    schema = wanted.schema() if isinstance(wanted, Table) else wanted
    if df is None:
        return spark.createDataFrame([], schema), "Created"
    lacking = [f for f in schema if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking]), "Modified" if lacking else "Unmodified"


def declared_struct(fields: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, spark_type(t)) for n, t in fields.items()])


def audit_point(df: DataFrame, column: str = "_auditdate") -> DataFrame:
    """The latest audit time and how many rows have it: one pass."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.max(column).alias("audit"), F.max_by("n", column).alias("rows"))


def export_changes(local: DataFrame, remote_audit: datetime | str | None, remote_rows: int, column: str = "_auditdate") -> DataFrame:
    """Rows since the remote's audit time: from it on if there are more rows of that time here, else after it."""
    if remote_audit is None:
        return local
    at = _ts(remote_audit)
    here = local.where(F.col(column).cast("timestamp") == at).count()
    return local.where(F.col(column).cast("timestamp") >= at if here > remote_rows else F.col(column).cast("timestamp") > at)


def export_stats(changes: DataFrame, column: str = "_auditdate") -> DataFrame:
    """The oldest audit time of exported rows and their number."""
    return changes.agg(F.min(column).alias("oldest"), F.count(F.lit(1)).alias("n"))


def import_changes(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the changes' keys replaced by them."""
    return table.join(changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)
