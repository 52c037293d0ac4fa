"""Row hashes and their order-insensitive sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(df: DataFrame, name: str, scale: int = 2) -> Column:
    """The text of a column that is the same in every engine: timestamps as whole seconds, doubles as decimals."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_seconds(c.cast("timestamp")).cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.cast(f"decimal(38,{scale})").cast("string")
    return c.cast("string")


def row_hash(df: DataFrame, fields: list[str], scale: int = 2) -> Column:
    """md5 of the fields' md5s, a blank for each null, so that neighbouring fields never run into each other."""
    return F.md5(F.concat(*[F.coalesce(F.md5(canonical(df, f, scale)), F.lit(" ")) for f in fields]))


def word(digest: Column, k: int) -> Column:
    """The k-th 32-bit word of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def checksum_of(digest: str = "hash") -> list[Column]:
    """Count and sums of the four words. Long sums hold two billion rows; beyond that `widened` adds up several of them."""
    return [F.count(F.lit(1)).alias("qty"), *[F.sum(word(F.col(digest), k)).alias(f"sum{k + 1}") for k in range(4)]]


def widened() -> list[Column]:
    """Sums over sums, in decimals that no number of rows overflows."""
    return [F.coalesce(F.sum("qty"), F.lit(0)).alias("qty"), *[F.sum(F.col(f"sum{k}").cast("decimal(20,0)")).alias(f"sum{k}") for k in range(1, 5)]]
