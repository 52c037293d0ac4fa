"""Nested values: leaves of structs as columns, and merges that go down to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged(old: Column, new: Column, kind: T.DataType) -> Column:
    """The new value where it is not null, else the old one; in structs field by field, in maps key by key."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[merged(old[f.name], new[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(old.isNotNull() | new.isNotNull(), inner)
    if isinstance(kind, T.MapType):
        held = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
        return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(held, F.map_filter(new, lambda _, v: v.isNotNull())))
    return F.coalesce(new, old)


def leaves(schema: T.StructType, at: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of all fields that are no structs."""
    out = []
    for f in schema.fields:
        out += leaves(f.dataType, (*at, f.name)) if isinstance(f.dataType, T.StructType) else [(*at, f.name)]
    return out


def flat(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[tuple[str, ...], str]]:
    """`df` with a column for each leaf of `columns` instead of them, and the columns' names by path."""
    paths = [p for p in leaves(df.schema) if p[0] in columns]
    names = {p: p[0] if len(p) == 1 else "\x1f".join(p) for p in paths}
    return df.select(*[c for c in df.columns if c not in columns], *[F.col(".".join(f"`{x}`" for x in p)).alias(n) for p, n in names.items()]), names


def nest(schema: T.StructType, names: dict[tuple[str, ...], str], at: tuple[str, ...] = ()) -> list[Column]:
    """Columns of `schema` put together again from their leaves; a struct without any value is null."""
    out = []
    for f in schema.fields:
        path = (*at, f.name)
        if isinstance(f.dataType, T.StructType):
            own = [F.col(f"`{n}`") for p, n in names.items() if p[: len(path)] == path]
            out.append(F.when(_any(own), F.struct(*nest(f.dataType, names, path))).alias(f.name))
        else:
            out.append(F.col(f"`{names[path]}`").alias(f.name))
    return out


def _any(columns: list[Column]) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | c.isNotNull()
    return found
