"""Domain objects: related ids to domain ids, nested documents, paged snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.reconcile import bucket_of


def translate(changed: DataFrame, key: str, spec: bool | list[str] | str | Callable[[DataFrame], DataFrame] | DataFrame | dict, view: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Domain ids (columns of the result) for changed ids of a related table.

    True: the ids are domain ids. A list: take these key columns. A table (changed key, domain key..): look up there. A
    dict {keys, translation}: the keys after that translation. SQL text: a query over view `changed_ids`. A function: the
    caller's own.
    """
    if isinstance(spec, dict):
        return translate(changed, key, spec["translation"], view).select(*spec["keys"]).distinct()
    if spec is True:
        return changed.select(key).distinct()
    if isinstance(spec, list):
        return changed.select(*spec).distinct()
    if isinstance(spec, DataFrame):
        return spec.join(changed.select(key).distinct(), key, "left_semi").drop(key).distinct()
    if isinstance(spec, str):
        changed.createOrReplaceTempView("changed_ids")
        return changed.sparkSession.sql(spec).distinct()
    return spec(changed).distinct()


def nest(df: DataFrame, prefixes: list[str], sep: str = "_") -> DataFrame:
    """Columns that begin with a prefix and `sep` as one struct column of that name."""
    inner = {p: [c for c in df.columns if c.startswith(p + sep)] for p in prefixes}
    plain = [c for c in df.columns if not any(c in cols for cols in inner.values())]
    return df.select(*plain, *[F.struct(*[F.col(c).alias(c[len(p + sep) :]) for c in cols]).alias(p) for p, cols in inner.items() if cols])


def has_one(main: DataFrame, other: DataFrame, left: str, right: str, name: str, columns: list[str]) -> DataFrame:
    """`main` with the one related row as a struct, null if there is none."""
    one = other.select(F.col(right).alias("__key"), F.struct(*columns).alias(name))
    return main.join(one, main[left] == F.col("__key"), "left").drop("__key")


def has_many(main: DataFrame, other: DataFrame, left: str, right: str, name: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """`main` with related rows as an array of structs in order, empty if there are none.

    Rows are gathered per key: an object must fit in memory, as it must in any document.
    """
    item = F.struct(*(order or []), *[c for c in columns if c not in (order or [])])
    many = other.groupBy(F.col(right).alias("__key")).agg(F.sort_array(F.collect_list(item)).alias("__items"))
    kind = other.select(F.array(F.struct(*columns))).schema[0].dataType
    shaped = F.transform("__items", lambda x: F.struct(*[x[c].alias(c) for c in columns]))
    return main.join(many, main[left] == F.col("__key"), "left").withColumn(name, F.coalesce(shaped, F.array().cast(kind))).drop("__key", "__items")


def objects(ids: DataFrame, key: str, main: DataFrame, joins: list[Callable[[DataFrame], DataFrame]], tombstones: bool = False, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Documents of the given ids; ids without a row are left out, or kept as `_deleted` ones."""
    found = main.join(ids.select(key).distinct(), key, "left_semi")
    for join in joins:
        found = join(found)
    found = transform(found) if transform else found
    if tombstones:
        gone = ids.select(key).distinct().join(main, key, "left_anti").withColumn("_deleted", F.lit(True))
        return found.withColumn("_deleted", F.lit(False)).unionByName(gone, allowMissingColumns=True)
    return found


def snapshot_pages(df: DataFrame, key: str, limit: int) -> DataFrame:
    """(page, start, end, rows) of pages by id ranges; a page is a unit of writing and of resuming."""
    return df.groupBy(bucket_of(F.col(key), limit).alias("page")).agg(F.min(key).alias("start"), F.max(key).alias("end"), F.count(F.lit(1)).alias("rows"))


def write_snapshot(df: DataFrame, key: str, limit: int, path: str, done: list[int] | None = None) -> DataFrame:
    """Pages as gzipped JSON under `path`/page=n, without those already done; gives the manifest."""
    page: Column = bucket_of(F.col(key), limit)
    rows = df.where(~page.isin(done)) if done else df
    rows.withColumn("page", page).repartition("page").write.mode("append").partitionBy("page").option("compression", "gzip").json(path)
    return snapshot_pages(rows, key, limit)
