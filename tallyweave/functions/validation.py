"""Table specs, and rows held against them. Failures are collected in one column; nothing is dropped silently."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A warehouse column: `scd` is 0 for none, else 1, 2, 3 or 6; `dimension` names what it links to."""

    name: str
    type: str = "varchar(255)"
    nk: bool = False
    sk: bool = False
    scd: int = 0
    dimension: str | None = None
    on: dict[str, str] | None = None
    dim_column: str | None = None
    values: tuple = ()
    default: Any = None


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    is_dimension: bool = False
    unknown_fields_fail: bool = True
    #: Another name that events may use, together with the kind of table.
    label: str | None = None
    #: Column groups without repeats besides the natural key.
    unique: tuple[tuple[str, ...], ...] = ()
    technical: tuple[str, ...] = field(default=("_auditdate", "_startdate", "_enddate", "_current", "_deleted"))

    @property
    def natural_key(self) -> list[str]:
        return [f.name for f in self.fields if f.nk]

    @property
    def surrogate_key(self) -> str | None:
        return next((f.name for f in self.fields if f.sk), None)

    def group(self, scd: int) -> list[str]:
        return [f.name for f in self.fields if f.scd == scd]

    def schema(self) -> T.StructType:
        """The table's columns with the technical ones of its kind."""
        own = [T.StructField(f.name, spark_type(f.type)) for f in self.fields]
        end = [("_auditdate", T.TimestampType()), *([("_startdate", T.TimestampType()), ("_enddate", T.TimestampType()), ("_current", T.BooleanType())] if self.is_dimension else [("_deleted", T.BooleanType())])]
        return T.StructType(own + [T.StructField(n, t) for n, t in end])


# Declared types and what holds them.
_TYPES = {"integer": T.IntegerType(), "bigint": T.LongType(), "float": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "datetime": T.TimestampType()}


def spark_type(declared: str) -> T.DataType:
    return _TYPES.get(declared.split("(")[0].strip().lower(), T.StringType())


def _problem(f: Field) -> Column | None:
    """What is wrong with a value, as text, or null."""
    c, kind = F.col(f.name), f.type.split("(")[0].strip().lower()
    as_text = c.cast("string")
    if kind == "varchar":
        longest = int(f.type.split("(")[1].rstrip(") ")) if "(" in f.type else 255
        wrong = F.when(F.length(as_text) > longest, F.lit(f"{f.name}: longer than {longest}"))
        return wrong.when(~as_text.isin(*f.values), F.lit(f"{f.name}: not an allowed value")) if f.values else wrong
    if kind in ("integer", "bigint"):
        whole = as_text.rlike(r"^-?[0-9]{1,19}$") & F.expr(f"try_cast(`{f.name}` as string)").isNotNull()
        fits = F.expr(f"try_cast(cast(`{f.name}` as string) as {'int' if kind == 'integer' else 'bigint'})").isNotNull()
        return F.when(~(whole & fits), F.lit(f"{f.name}: no {kind}"))
    if kind == "float":
        return F.when(F.expr(f"try_cast(cast(`{f.name}` as string) as double)").isNull(), F.lit(f"{f.name}: no float"))
    if kind in ("timestamp", "datetime"):
        return F.when(F.expr(f"try_cast(cast(`{f.name}` as string) as timestamp)").isNull(), F.lit(f"{f.name}: no {kind}"))
    return None


def errors(df: DataFrame, table: Table) -> Column:
    """All that is wrong with a row. A value equal to the field's default is always right."""
    found = []
    declared = {f.name for f in table.fields}
    for f in table.fields:
        if f.name not in df.columns:
            if f.nk:
                found.append(F.lit(f"{f.name}: key missing"))
            continue
        text = F.col(f.name).cast("string")
        if f.nk:
            found.append(F.when(F.coalesce(text, F.lit("")) == "", F.lit(f"{f.name}: key missing")))
        problem = _problem(f)
        if problem is not None:
            fine = F.lit(False) if f.default is None else text == str(f.default)
            found.append(F.when(F.col(f.name).isNotNull() & ~fine, problem))
    if table.unknown_fields_fail:
        found += [F.when(F.col(c).isNotNull(), F.lit(f"{c}: unknown field")) for c in df.columns if c not in declared and not c.startswith("_")]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def split(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """(rows that hold, rows that do not with their `errors`)."""
    checked = df.withColumn("errors", errors(df, table))
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def expand_deletes(df: DataFrame, ids: str = "ids", entities: str = "entities") -> DataFrame:
    """One row for each id and entity of a delete event; entities are structs (type, name, field). Events without ids or
    entities give no rows: reject them with `bad_deletes`."""
    rows = df.withColumn("__id", F.explode(ids)).withColumn("__entity", F.explode(entities))
    rest = [c for c in df.columns if c not in (ids, entities)]
    return rows.select(*rest, F.col("__entity.type").alias("type"), F.col("__entity.name").alias("entity"), F.col("__entity.field").alias("field"), F.col("__id").alias("id"), F.concat(F.lit("_del_"), F.col("__id").cast("string")).alias("key"))


def bad_deletes(df: DataFrame, ids: str = "ids", entities: str = "entities") -> DataFrame:
    return df.where((F.coalesce(F.size(ids), F.lit(0)) <= 0) | (F.coalesce(F.size(entities), F.lit(0)) <= 0) | F.exists(ids, lambda x: x.isNull()))
