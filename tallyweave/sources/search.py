"""Search requests: builders of the query language, and the same queries evaluated over a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def between(field: str, start=None, end=None) -> dict:
    """A range with both ends included; an open end stays away."""
    bounds = {name: value for name, value in (("gte", start), ("lte", end)) if value is not None}
    return {"range": {field: bounds}}


def any_of(field: str, values: list) -> dict:
    return {"terms": {field: list(values)}}


def all_of(*queries: dict | None) -> dict:
    """Queries that must all hold; a lone one stands for itself."""
    parts = [q for q in queries if q]
    return {"match_all": {}} if not parts else parts[0] if len(parts) == 1 else {"bool": {"must": parts}}


def request(query: dict, aggs: dict | None = None, sort: list | None = None, source: list[str] | bool | None = None, size: int | None = None) -> dict:
    named = {"query": query, "aggs": aggs, "sort": sort, "_source": source, "size": size}
    return {k: v for k, v in named.items() if v is not None}


def column(query: dict) -> Column:
    """A query as a condition on columns."""
    (kind, body), *more = query.items()
    if more:
        raise ValueError("a query has one kind")
    if kind == "match_all":
        return F.lit(True)
    if kind == "bool":
        parts = [column(q) for q in body.get("must", []) + body.get("filter", [])]
        parts += [~F.coalesce(column(q), F.lit(False)) for q in body.get("must_not", [])]
        if body.get("should"):
            parts.append(reduce(lambda a, b: a | b, map(column, body["should"])))
        return reduce(lambda a, b: a & b, parts, F.lit(True))
    (field, value), = body.items()
    if kind == "range":
        ops = {"gte": lambda v: F.col(field) >= v, "gt": lambda v: F.col(field) > v, "lte": lambda v: F.col(field) <= v, "lt": lambda v: F.col(field) < v}
        return reduce(lambda a, b: a & b, [ops[op](v) for op, v in value.items()], F.lit(True))
    if kind == "terms":
        return F.col(field).isin(*value)
    if kind in ("term", "match"):
        return F.col(field) == value
    if kind == "exists":
        return F.col(value).isNotNull()
    raise ValueError(f"no query kind {kind!r}")


def found(df: DataFrame, asked: dict) -> DataFrame:
    """What a request finds in a table: filtered, sorted and projected; its size is a limit as the service has one."""
    rows = df.where(column(asked.get("query", {"match_all": {}})))
    for by in [asked["sort"]] if asked.get("sort") else []:
        rows = rows.orderBy(*[F.col(f).desc() if d == "desc" else F.col(f).asc() for x in by for f, d in x.items()])
    rows = rows.limit(asked["size"]) if "size" in asked else rows
    return rows.select(*asked["_source"]) if isinstance(asked.get("_source"), list) else rows


def ids_of(df: DataFrame, queries: list[dict], key: str) -> DataFrame:
    """Ids that any of the queries finds."""
    return df.where(reduce(lambda a, b: a | b, map(column, queries), F.lit(False))).select(key)
