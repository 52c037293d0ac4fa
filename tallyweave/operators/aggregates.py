"""Measures per entity and time bucket: reversible sums, extremes, first and last, changes, and the merge of batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.scalars import bucket_label


def with_buckets(rows: DataFrame, ts: str, buckets: list[str]) -> DataFrame:
    """A row for each bucket: `category` names it, `bucket` is the label. A bucket asked for twice counts once."""
    pairs = F.array(*[F.struct(F.lit(b or "all").alias("category"), bucket_label(F.col(ts), b).alias("bucket")) for b in dict.fromkeys(buckets)])
    return rows.withColumn("__b", F.explode(pairs)).select(*rows.columns, "__b.category", "__b.bucket")


def total(v: Column, is_old: Column | None = None) -> Column:
    """Sum that takes back old values."""
    return F.coalesce(F.sum(v if is_old is None else F.when(is_old, -v).otherwise(v)), F.lit(0))


def least(v: Column, is_old: Column | None = None) -> Column:
    """Minimum of new values: without the history it cannot take one back."""
    return F.min(v if is_old is None else F.when(~is_old, v))


def most(v: Column, is_old: Column | None = None) -> Column:
    return F.max(v if is_old is None else F.when(~is_old, v))


def first(v: Column, date: Column, seq: Column) -> Column:
    """Value of the earliest date; the earliest arrival of equal ones."""
    return F.min_by(v, F.struct(date, seq))


def last(v: Column, date: Column, seq: Column) -> Column:
    """Value of the latest date; the earliest arrival of equal ones."""
    return F.max_by(v, F.struct(date, -seq))


def count_changes(rows: DataFrame, by: list[str], value: str, seq: list[str]) -> DataFrame:
    """How often a value differs from the one before, in order of arrival; the first is no change."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(*seq))
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*seq))
    changed = (number > 1) & ~F.col(value).eqNullSafe(before)
    return rows.withColumn("__changed", changed.cast("int")).groupBy(*by).agg(F.sum("__changed").cast("long").alias("changes"))


def by_key(rows: DataFrame, by: list[str], key: str, measure: Column, name: str = "values") -> DataFrame:
    """A map from a grouping key to a measure, for each group."""
    each = rows.groupBy(*by, key).agg(measure.alias("__m"))
    return each.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, "__m")))).alias(name))


def tree(measures: dict) -> list[Column]:
    """Aggregates of a nested plan: a name leads to an aggregate, or to a plan of its own that becomes a struct."""
    return [(F.struct(*tree(m)) if isinstance(m, dict) else m).alias(name) for name, m in measures.items()]


def query(aggregates: DataFrame, entity_id, start: str | None = None, end: str | None = None, category: str | None = None, limit: int | None = None) -> DataFrame:
    """Buckets of one id between labels."""
    rows = aggregates.where(F.col("id") == entity_id)
    rows = rows.where(F.col("bucket") >= start) if start is not None else rows
    rows = rows.where(F.col("bucket") <= end) if end is not None else rows
    rows = rows.where(F.col("category") == category) if category is not None else rows
    return rows.orderBy("bucket").limit(limit) if limit else rows


# What the aggregator keeps of each measure, and how two states of it are added.
STATE = ("count", "sum", "min", "max", "first", "last")


def partial(rows: DataFrame, value: str, ts: str, seq: str, is_old: str | None = None) -> DataFrame:
    """State of one batch for each (id, category, bucket)."""
    old = F.coalesce(F.col(is_old), F.lit(False)) if is_old else F.lit(False)
    v = F.col(value)
    place = F.struct(F.col(ts).alias("date"), F.col(seq).alias("seq"), v.alias("v"))
    late = F.struct(F.col(ts).alias("date"), (-F.col(seq)).alias("seq"), v.alias("v"))
    return rows.groupBy("id", "category", "bucket").agg(
        F.sum(F.when(old, -1).otherwise(1)).cast("long").alias("count"), total(v, old).alias("sum"), least(v, old).alias("min"), most(v, old).alias("max"),
        F.min(F.when(~old, place)).alias("first"), F.max(F.when(~old, late)).alias("last"),
    )


def merged(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """State after a batch with the state before it as `p`: replaying the batch starts from there."""
    both = stored.select("id", "category", "bucket", F.struct(*STATE).alias("o")).join(batch.select("id", "category", "bucket", F.struct(*STATE).alias("n")), ["id", "category", "bucket"], "full_outer")
    add = lambda c: F.coalesce(F.col("o")[c] + F.col("n")[c], F.col("o")[c], F.col("n")[c])
    out = {"count": add("count"), "sum": add("sum"), "min": F.least(F.col("o")["min"], F.col("n")["min"]), "max": F.greatest(F.col("o")["max"], F.col("n")["max"])}
    out |= {"first": F.array_min(F.array_compact(F.array(F.col("o")["first"], F.col("n")["first"]))), "last": F.array_max(F.array_compact(F.array(F.col("o")["last"], F.col("n")["last"])))}
    return both.select("id", "category", "bucket", *[c.alias(n) for n, c in out.items()], F.col("o").alias("p"))


def current(state: DataFrame) -> DataFrame:
    """Plain values of the present state."""
    return state.select("id", "category", "bucket", "count", "sum", "min", "max", F.col("first.v").alias("first"), F.col("last.v").alias("last"))


def previous(state: DataFrame) -> DataFrame:
    """Plain values before the last batch."""
    return state.select("id", "category", "bucket", *[F.col(f"p.{c}").alias(c) for c in STATE[:4]], F.col("p.first.v").alias("first"), F.col("p.last.v").alias("last"))


def meta(state: DataFrame, of: str = "current") -> DataFrame:
    """Dates that stand behind first and last."""
    at = "" if of == "current" else "p."
    return state.select("id", "category", "bucket", F.col(f"{at}first.date").alias("first_date"), F.col(f"{at}last.date").alias("last_date"))
