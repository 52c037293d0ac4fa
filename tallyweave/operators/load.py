"""A warehouse load as one call: validate, expand deletes, fold, import, add missing members, link; driven by table specs.

Events are rows (seq, type, table, data, ids, entities): `type` is fact, dimension or delete; `table` names a spec or its
label; `data` maps column names to texts; deletes have `ids` and `entities` (type, name, field). The tables are snapshots:
the load takes those there are and gives the next ones, so running it again with the same audit time changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.scalars import date_key, fk_column, time_key
from tallyweave.functions.validation import Table, bad_deletes, expand_deletes, spark_type, split
from tallyweave.operators import warehouse as W

EVENTS = "seq bigint, type string, table string, data map<string,string>, ids array<string>, entities array<struct<type: string, name: string, field: string>>"
# Dimensions that stand for parts of a point in time and have no table.
DATETIMES, DATES, TIMES = ("d_datetime", "datetime", "dim_datetime"), ("d_date", "date", "dim_date"), ("d_time", "time", "dim_time")


@dataclass(frozen=True)
class Link:
    """A key column of a table, and where its values come from: `on` maps the table's columns to the dimension's."""

    dimension: str
    on: dict[str, str]
    column: str
    sk: str = "d_id"
    at: str = "_auditdate"


@dataclass
class Loaded:
    tables: dict[str, DataFrame]
    rejected: DataFrame
    used: list[str] = field(default_factory=list)


def links_of(table: Table, specs: dict[str, Table], at: str = "_auditdate", name: Callable[[str], str] | None = None) -> list[Link]:
    """The links that a spec declares: a field's `on`, or the dimension's only key column."""
    out = []
    for f in table.fields:
        if not f.dimension:
            continue
        column = (name or fk_column)(f.name) if not f.dim_column else f.dim_column
        if f.dimension in (*DATETIMES, *DATES, *TIMES):
            out.append(Link(f.dimension, {f.name: ""}, column))
            continue
        dim = specs[f.dimension]
        keys = dim.natural_key
        if not f.on and len(keys) != 1:
            raise ValueError(f"{table.name}.{f.name}: `on` must name the columns for {keys}")
        out.append(Link(f.dimension, dict(f.on) if f.on else {f.name: keys[0]}, column, dim.surrogate_key or "d_id", at))
    return out


def link_all(rows: DataFrame, links: list[Link], dims: dict[str, DataFrame], audit_ts=None, linked_ts=None) -> DataFrame:
    """`rows` with the key columns of all links: the version valid at the link's time, 1 where there is none; parts of a
    point in time are computed. With `audit_ts` only rows of that audit time are linked and take `linked_ts` if given."""
    touched = rows if audit_ts is None else rows.where(F.col("_auditdate").eqNullSafe(W._ts(audit_ts)))
    out = touched
    for x in links:
        out = out.drop(*[c for c in columns_of(x) if c in out.columns])
        source = F.col(next(iter(x.on))).cast("timestamp")
        if x.dimension in (*DATETIMES, *DATES):
            out = out.withColumn(f"{x.column}_date", date_key(source))
        if x.dimension in (*DATETIMES, *TIMES):
            out = out.withColumn(f"{x.column}_time", time_key(source))
        if x.dimension not in (*DATETIMES, *DATES, *TIMES):
            out = W.link(out, dims[x.dimension], x.on, x.sk, x.at, x.column)
    if audit_ts is None:
        return out
    if linked_ts is not None:
        out = out.withColumn("_auditdate", W._ts(linked_ts))
    rest = rows.where(~F.col("_auditdate").eqNullSafe(W._ts(audit_ts)))
    return rest.unionByName(out, allowMissingColumns=True)


def columns_of(link: Link) -> list[str]:
    if link.dimension in DATETIMES:
        return [f"{link.column}_date", f"{link.column}_time"]
    return [f"{link.column}_date"] if link.dimension in DATES else [f"{link.column}_time"] if link.dimension in TIMES else [link.column]


def load(spark: SparkSession, specs: list[Table], tables: dict[str, DataFrame], events: DataFrame, audit_ts, parts: int | None = None, name: Callable[[str], str] | None = None) -> Loaded:
    """The tables after a load, and the rejected events with their errors."""
    by_name = {t.name: t for t in specs}
    rejected = [_reject(events.where("type is null or type not in ('fact', 'dimension', 'delete') or (type <> 'delete' and table is null)"), "invalid event")]
    deletes = events.where("type = 'delete'")
    bad = bad_deletes(deletes)
    rejected.append(_reject(bad, "no ids in delete"))
    good = deletes.where((F.size("ids") > 0) & (F.size("entities") > 0) & ~F.exists("ids", lambda x: x.isNull()))
    gone = expand_deletes(good.select("seq", "ids", "entities"))
    rows = events.where("type in ('fact', 'dimension') and table is not null")
    known = F.lit(False)
    after: dict[str, DataFrame] = {}
    staged: dict[str, DataFrame] = {}
    for spec in specs:
        mine = _is_of(spec, F.col("table"), F.col("type"))
        known = known | mine
        own, wrong = _checked(rows.where(mine), spec)
        rejected.append(wrong)
        before = tables.get(spec.name)
        before = W.create_table(spark, spec) if before is None else W.evolve(before, spec)[0]
        here = gone.where(_is_of(spec, F.col("entity"), F.col("type")))
        staged[spec.name] = own
        after[spec.name] = _imported(before, own, here, spec, audit_ts, parts)
    rejected.append(_reject(rows.where(~F.coalesce(known, F.lit(False))), "no matching table"))
    for spec in specs:
        for x in links_of(spec, by_name, name=name):
            if x.dimension in after:
                dim = after[x.dimension]
                changed = after[spec.name].where(F.col("_auditdate").eqNullSafe(W._ts(audit_ts)))
                after[x.dimension] = W.missing_members(dim, changed, {d: f for f, d in x.on.items()}, x.sk, audit_ts, parts)
    for spec in specs:
        links = links_of(spec, by_name, name=name)
        if links:
            after[spec.name] = link_all(after[spec.name], links, after, audit_ts)
    out = rejected[0]
    for more in rejected[1:]:
        out = out.unionByName(more)
    return Loaded(after, out, [t.name for t in specs])


def _is_of(spec: Table, table: Column, kind: Column) -> Column:
    """By the table's name, or by its label together with its kind."""
    named = table == spec.name
    return named if spec.label is None else named | ((table == spec.label) & (kind == ("dimension" if spec.is_dimension else "fact")))


def _reject(rows: DataFrame, why: str) -> DataFrame:
    return rows.select("seq", "table", F.array(F.lit(why)).alias("errors"))


def _checked(rows: DataFrame, spec: Table) -> tuple[DataFrame, DataFrame]:
    """(rows that hold with typed columns, the others with their errors). Columns that are not declared reject a row."""
    declared = [f.name for f in spec.fields if not f.sk]
    flat = rows.select("seq", "table", "data", *[F.col("data")[c].alias(c) for c in declared])
    held, wrong = split(flat.select("*").withColumnsRenamed({"seq": "_seq", "table": "_table", "data": "_data"}), spec)
    strange = F.transform(F.filter(F.map_keys("_data"), lambda k: ~k.isin(*declared)), lambda k: F.concat(k, F.lit(": unknown field"))) if spec.unknown_fields_fail else F.array().cast("array<string>")
    odd = held.where(F.size(strange) > 0).select(F.col("_seq").alias("seq"), F.col("_table").alias("table"), strange.alias("errors"))
    wrong = wrong.select(F.col("_seq").alias("seq"), F.col("_table").alias("table"), "errors")
    typed = held.where(F.size(strange) <= 0).select(F.col("_seq").alias("seq"), *[F.expr(f"try_cast(`{f.name}` as {spark_type(f.type).simpleString()})").alias(f.name) for f in spec.fields if not f.sk])
    return typed, wrong.unionByName(odd)


def _imported(before: DataFrame, own: DataFrame, gone: DataFrame, spec: Table, audit_ts, parts: int | None) -> DataFrame:
    """A table after its folded events: deletes by the only key column are part of the fold, others come after it."""
    keys = spec.natural_key
    columns = [f.name for f in spec.fields if not f.sk and f.name not in keys]
    in_fold = len(keys) == 1
    rows = own.withColumn("__is_delete", F.lit(False))
    if in_fold:
        by_key = gone.where(F.col("field") == keys[0]).select("seq", F.expr(f"try_cast(id as {before.schema[keys[0]].dataType.simpleString()})").alias(keys[0]), F.lit(True).alias("__is_delete"))
        rows = rows.unionByName(by_key.where(F.col(keys[0]).isNotNull()), allowMissingColumns=True)
    folded = W.fold(rows, keys, "seq", columns, "__is_delete")
    if spec.is_dimension:
        out = W.scd_load(before, folded.where("not _deleted").drop("_deleted"), spec, audit_ts, parts)
        out = W.soft_delete_dimension(out, folded.where("_deleted"), keys[0], audit_ts) if in_fold else out
    else:
        out = W.fact_upsert(before, folded.withColumnRenamed("_deleted", "__was"), keys, audit_ts, "__was")
    for f in spec.fields:
        if f.sk or in_fold and f.name == keys[0]:
            continue
        ids = gone.where(F.col("field") == f.name).select(F.expr(f"try_cast(id as {before.schema[f.name].dataType.simpleString()})").alias(f.name)).where(F.col(f.name).isNotNull())
        out = (W.soft_delete_dimension if spec.is_dimension else W.soft_delete_fact)(out, ids, f.name, audit_ts)
    return out
