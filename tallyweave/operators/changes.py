"""Change feeds: folding events to ids, resuming, histories, old and new images, and the text of logical decoding."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.scalars import inflate, lsn_parts

EVENT = "op string, schema string, table string, id string, position string, ts timestamp"


def operation(column: Column) -> Column:
    """Inserts and updates are updates to a consumer of ids; everything else is told by its name."""
    low = F.lower(column)
    return F.when(low.isin("insert", "write", "update", "i", "u", "c"), "update").when(low.isin("delete", "d"), "delete")


def fold_ids(events: DataFrame, keys: list[str]) -> DataFrame:
    """(op, schema, table, ids): each id once, in order; several key columns make a struct."""
    key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    return events.groupBy("op", "schema", "table").agg(F.sort_array(F.collect_set(key)).alias("ids"))


def fold_pages(events: DataFrame, keys: list[str], size: int = 10_000) -> DataFrame:
    """(op, schema, table, page, ids): like fold_ids with about `size` ids in a page, so that no table's ids meet in one row.
    The number of pages follows each table's number of events; a page is chosen by hash, so an id is in one page only."""
    key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    # one row for each table and operation
    pages = events.groupBy("op", "schema", "table").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias("__pages"))
    paged = events.join(F.broadcast(pages), ["op", "schema", "table"]).withColumn("page", F.pmod(F.xxhash64(*keys), F.col("__pages")).cast("int"))
    return paged.groupBy("op", "schema", "table", "page").agg(F.sort_array(F.collect_set(key)).alias("ids"))


def resume(tables: dict[str, tuple[DataFrame, list[str]]], version: int, after: tuple | None = None) -> DataFrame:
    """Changes of several tables, each (rows with `version`, key columns), after a position (version, key texts)."""
    out = None
    for name, (rows, keys) in sorted(tables.items()):
        one = rows.select(F.lit(name).alias("table"), F.col("version").cast("long").alias("version"), F.array(*[F.col(k).cast("string") for k in keys]).alias("key"), F.struct(*keys).alias("__key"))
        later = F.col("version") > version
        if after is not None:
            later = later | ((F.col("version") == version) & (F.col("__key") > F.struct(*[F.lit(a).cast(rows.schema[k].dataType) for a, k in zip(after, keys)])))
        one = one.where(later).drop("__key")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def history(events: DataFrame, key: str, op: str, seq: str) -> DataFrame:
    """Last operation, its place and the number of operations of each id."""
    return events.groupBy(key).agg(F.max_by(op, seq).alias("last_op"), F.max(seq).alias("last_seq"), F.count(F.lit(1)).alias("n"))


def enrich(events: DataFrame, current: DataFrame, key: str, op: str, seq: str, handler: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None, schema: str | None = None, keep: Column | None = None) -> DataFrame:
    """Each changed id with its current row, or as a delete if that was last or no row is left.

    `keep` filters events; a handler makes any number of rows out of each.
    """
    last = history(events if keep is None else events.where(keep), key, op, seq)
    met = last.join(current.withColumn("__there", F.lit(True)), key, "left")
    gone = (F.col("last_op") == "delete") | F.col("__there").isNull()
    out = met.withColumn("deleted", gone).drop("__there", "n")
    return out.mapInPandas(handler, schema) if handler else out


def old_new(rows: DataFrame, key: str, seq: str, columns: list[str]) -> DataFrame:
    """(key, seq, old, new): each image with the one before; both null-safe."""
    image = F.struct(*columns)
    return rows.select(key, seq, F.lag(image).over(Window.partitionBy(key).orderBy(seq)).alias("old"), image.alias("new"))


def route(rows: DataFrame, partition: Column, queues: dict[str, str], default: str) -> DataFrame:
    """`rows` with the queue that a partition's name, up to its last hyphen, goes to."""
    name = F.regexp_extract(partition, r"^(.*)-[^-]*$", 1)
    out = F.lit(default)
    for prefix, queue in queues.items():
        out = F.when(name == prefix, queue).otherwise(out)
    return rows.withColumn("queue", out)


def merge_images(old: Column, new: Column) -> Column:
    """The new image's values over the old one's, whatever the session does with repeated keys."""
    nothing = F.create_map().cast("map<string,string>")
    kept = F.map_filter(F.coalesce(old, nothing), lambda k, _: ~F.array_contains(F.map_keys(F.coalesce(new, nothing)), k))
    return F.map_concat(kept, F.coalesce(new, nothing))


def inflate_images(rows: DataFrame, column: str) -> DataFrame:
    """Stored payloads back to text: those that are compressed (base 64 that begins like a zlib stream), the rest as they are."""
    return rows.withColumn(column, F.coalesce(inflate(F.when(F.col(column).rlike("^eJ[A-Za-z0-9+/]+=*$"), F.col(column))), column))


def processed(rows: DataFrame, key: str, seq: str, image: str, partition: Column, queues: dict[str, str], default: str) -> DataFrame:
    """Stored images as (key, seq, old, new, queue): inflated, paired with the one before, routed by partition."""
    paired = old_new(inflate_images(rows, image).withColumn("__p", partition), key, seq, [image, "__p"])
    return route(paired, F.col("new.__p"), queues, default).select(key, seq, F.col(f"old.{image}").alias("old"), F.col(f"new.{image}").alias("new"), "queue")

_HEADER = re.compile(r'table (?P<schema>"(?:[^"]|"")*"|[^.\s]+)\.(?P<table>"(?:[^"]|"")*"|[^:]+): (?P<op>[A-Z]+):\s*(?P<rest>.*)$', re.S)
_DATUM = re.compile(r"""\s*(?P<name>"(?:[^"]|"")*"|[^\[\s"]+)\[(?P<type>(?:[^\[\]]|\[\])*)\]:(?P<value>'(?:[^']|'')*'|\S+)""", re.S)
_BOUND = re.compile(r"(?P<what>BEGIN|COMMIT)(?: (?P<xid>\d+))?(?: \(at (?P<at>[^)]*)\))?\s*$")

DECODED = "kind string, xid bigint, time string, schema string, tbl string, op string, old map<string,string>, new map<string,string>, types map<string,string>"


def _name(text: str) -> str:
    return text[1:-1].replace('""', '"') if text.startswith('"') else text


def _datums(text: str) -> tuple[dict, dict]:
    values, types, at = {}, {}, 0
    while at < len(text.rstrip()):
        m = _DATUM.match(text, at)
        if not m:
            raise ValueError(f"no datum at {text[at : at + 40]!r}")
        raw, name = m["value"], _name(m["name"])
        values[name] = None if raw == "null" else raw[1:-1].replace("''", "'") if raw.startswith("'") else raw
        types[name] = m["type"]
        at = m.end()
    return values, types


def decode_line(line: str) -> dict:
    """One line of the test_decoding plugin: a transaction border, or a row's operation with old and new values as text."""
    empty = {k.split()[0]: None for k in DECODED.split(", ")}
    if bound := _BOUND.match(line):
        return empty | {"kind": bound["what"].lower(), "xid": int(bound["xid"]) if bound["xid"] else None, "time": bound["at"]}
    if not (m := _HEADER.match(line)):
        return empty | {"kind": "unreadable"}
    rest, old = m["rest"], {}
    try:
        if rest.startswith("old-key:"):
            before, _, rest = rest.removeprefix("old-key:").partition("new-tuple:")
            old, _ = _datums(before.strip())
        values, types = ({}, {}) if rest.strip() == "(no-tuple-data)" else _datums(rest.strip())
    except ValueError:
        return empty | {"kind": "unreadable"}
    return empty | {"kind": "row", "schema": _name(m["schema"]), "tbl": _name(m["table"]), "op": m["op"], "old": old, "new": values, "types": types}


def decode(lines: DataFrame, text: str = "value") -> DataFrame:
    """Decoded lines: a grammar with quoting needs a tokenizer, so batches go through Python."""

    @F.pandas_udf(DECODED)
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode_line(v or "") for v in values], columns=[k.split()[0] for k in DECODED.split(", ")]).astype({"xid": "Int64"})

    return lines.withColumn("d", run(F.col(text))).select(*[c for c in lines.columns if c != text], "d.*")


def after_lsn(rows: DataFrame, column: str, last: str) -> DataFrame:
    """Rows past a log position."""
    return rows.where(lsn_parts(F.col(column)) > lsn_parts(F.lit(last)))
