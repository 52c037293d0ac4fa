"""Scalar expressions: warehouse keys, log positions, entity partitions, bucket labels, name normalising."""

from __future__ import annotations

import base64
import re
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_DAY, KEY_BASE, UNKNOWN_KEY = "1400-01-01", 10000, 1


def date_key(ts: Column) -> Column:
    """Days since 1400 plus the base; 1 for null."""
    return F.coalesce(F.datediff(ts.cast("date"), F.lit(EPOCH_DAY).cast("date")) + KEY_BASE, F.lit(UNKNOWN_KEY)).cast("long")


def time_key(ts: Column) -> Column:
    """Seconds of the day plus the base; 1 for null."""
    return F.coalesce(F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts) + KEY_BASE, F.lit(UNKNOWN_KEY)).cast("long")


def lsn_parts(lsn: Column) -> Column:
    """A log position X/Y as a comparable struct of two numbers."""
    half = lambda i: F.conv(F.get(F.split(lsn, "/"), F.lit(i)), 16, 10).cast("long")
    return F.struct(half(0).alias("upper"), half(1).alias("lower"))


def lsn_number(lsn: Column) -> Column:
    """A log position as one number."""
    parts = lsn_parts(lsn)
    return parts["upper"].cast("decimal(20,0)") * F.lit(4294967296).cast("decimal(20,0)") + parts["lower"]


def lsn_text(upper: Column, lower: Column) -> Column:
    return F.concat(F.conv(upper.cast("string"), 10, 16), F.lit("/"), F.conv(lower.cast("string"), 10, 16))


def lsn_next(lsn: Column) -> Column:
    """The position after this one."""
    parts = lsn_parts(lsn)
    full = parts["lower"] == 0xFFFFFFFF
    return lsn_text(parts["upper"] + full.cast("long"), F.when(full, F.lit(0)).otherwise(parts["lower"] + 1))


def hash31(text: Column) -> Column:
    """Each character added to 31 times what came before, wrapping at 32 bits with a sign."""
    codes = F.transform(F.filter(F.split(text, ""), lambda ch: ch != ""), F.ascii)  # the code point, also past ASCII
    return F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: F.pmod(h * 31 + c + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31))


def entity_partition(entity: str, key: Column, count: int = 10) -> Column:
    """`entity-n` for a key: numbers by their remainder, texts by hash31, always from 0 up."""
    return F.concat(F.lit(entity + "-"), F.pmod(F.abs(hash31(key.cast("string"))), F.lit(count)).cast("string"))


# Bucket names and the labels' date patterns.
BUCKET_PATTERNS = {
    "secondly": "yyyy-MM-dd HH:mm:ss",
    "minutely": "yyyy-MM-dd HH:mm",
    "hourly": "yyyy-MM-dd HH",
    "daily": "yyyy-MM-dd",
    "monthly": "yyyy-MM",
    "quarterly": "yyyy-Q",
}


def bucket_label(ts: Column, bucket: str) -> Column:
    """The label of a time in a bucket; weekly is calendar year and ISO week; alltime, all and '' are one bucket; any
    other name is a date pattern of its own."""
    if bucket in ("alltime", "all", ""):
        return F.lit("all")
    if bucket == "weekly":
        return F.concat(F.year(ts).cast("string"), F.lit("-"), F.weekofyear(ts).cast("string"))
    return F.date_format(ts, BUCKET_PATTERNS.get(bucket, bucket))


def snake(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()).strip("_")


def table_name(entity: str, is_dimension: bool) -> str:
    return ("d_" if is_dimension else "f_") + snake(entity)


def column_name(name: str) -> str:
    """Semantic names lead with a capital: `Ts:x` is x_ts, any other `Kind:x` is x_id; the rest is lowered."""
    kind, colon, rest = name.partition(":")
    if colon and kind[:1].isupper():
        return snake(rest) + ("_ts" if kind == "Ts" else "_id")
    return re.sub(r"[^a-z0-9_]+", "_", name.lower())


def normalise_fields(df: DataFrame, longest: int = 4000) -> DataFrame:
    """Columns under their normal names; texts cut to what a warehouse column holds; structs flattened."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "struct":
            out += [c[sub.name].alias(f"{column_name(f.name)}_{column_name(sub.name)}") for sub in f.dataType.fields]
        else:
            out.append((F.substring(c, 1, longest) if f.dataType.simpleString() == "string" else c).alias(column_name(f.name)))
    return df.select(*out)


def iso_time(text: Column) -> Column:
    """The time that a text holds if it is an ISO date with or without a time, else null."""
    whole = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$")
    return F.when(whole, F.try_to_timestamp(F.regexp_replace(text, " ", "T")))


def fk_column(column: str, dim_column: str | None = None) -> str:
    """Name of the key column that links to a dimension."""
    return dim_column or "d_" + column.removesuffix("_id")


def for_load(text: Column) -> Column:
    """Text as a warehouse loads it: '' is null, carriage returns become line feeds."""
    return F.nullif(F.regexp_replace(text, "\r\n?", "\n"), F.lit(""))


@F.pandas_udf(T.StringType())
def deflate(payload: pd.Series) -> pd.Series:
    """Payload compressed and in base 64; a storage detail outside of any hot path."""
    return payload.map(lambda x: None if x is None else base64.b64encode(zlib.compress(x.encode())).decode())


@F.pandas_udf(T.StringType())
def inflate(payload: pd.Series) -> pd.Series:
    return payload.map(lambda x: None if x is None else zlib.decompress(base64.b64decode(x)).decode())
