"""Predicates from plain data: id limits and where-trees. Values are bound as literals, so nothing needs escaping."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<>": lambda c, v: c != v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "in": lambda c, v: c.isin(*v), "not in": lambda c, v: ~c.isin(*v),
    "between": lambda c, v: c.between(*v), "like": lambda c, v: c.like(v), "is null": lambda c, v: c.isNull(), "is not null": lambda c, v: c.isNotNull(),
}


def id_limit(key: Column, ids: list | None = None, start: Any = None, end: Any = None) -> Column:
    """ids: one of them; else between the bounds that are given; else everything."""
    if ids is not None:
        return key.isin(*ids)
    parts = [key >= start] * (start is not None) + [key <= end] * (end is not None)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def only_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows of ids that are themselves a table, for lists too long for a literal."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def where_tree(tree: Any) -> Column:
    """Text is raw SQL; a list holds all of its parts; a dict is {field, op, value}, {_: raw}, {or: [..]}, {and: [..]} or
    {field: value, ..}."""
    if tree is None or tree == [] or tree == {}:
        return F.lit(True)
    if isinstance(tree, str):
        return F.expr(tree)
    if isinstance(tree, (list, tuple)):
        return reduce(lambda a, b: a & b, map(where_tree, tree))
    if "field" in tree:
        op = tree.get("op", "=").lower()
        if op not in _OPS:
            raise ValueError(f"no operator {op!r}")
        return _OPS[op](F.col(tree["field"]), tree.get("value"))
    parts = []
    for name, value in tree.items():
        if name == "_":
            parts.append(F.expr(value))
        elif name == "or":
            parts.append(reduce(lambda a, b: a | b, map(where_tree, value)))
        elif name == "and":
            parts.append(where_tree(value))
        else:
            parts.append(F.col(name).isNull() if value is None else F.col(name) == value)
    return reduce(lambda a, b: a & b, parts)
