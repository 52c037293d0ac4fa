"""Keyed entities: upserts where the last write wins, column-wise merges, loading with key checks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.nested import merged
from tallyweave.functions.scalars import deflate, entity_partition
from tallyweave.operators.warehouse import fold


def upsert(stored: DataFrame, written: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Stored rows replaced by the last write of their key. Partial aggregation keeps a hot key from piling up."""
    rest = [c for c in written.columns if c not in keys and c != seq]
    last = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("__row")).select(*keys, "__row.*")
    return stored.join(last.select(*keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


def merge(stored: DataFrame, written: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Stored rows with each column's last written value that is not null; structs and maps field by field."""
    columns = [c for c in written.columns if c not in keys and c != seq]
    last = fold(written, keys, seq, columns)
    cond = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    both = stored.alias("o").join(last.alias("n"), cond, "full_outer")

    def pick(c: str) -> Column:
        if c in last.columns and c in stored.columns and c not in keys:
            return merged(F.col(f"o.{c}"), F.col(f"n.{c}"), stored.schema[c].dataType)
        return F.coalesce(*[F.col(f"n.{c}")] * (c in last.columns), *[F.col(f"o.{c}")] * (c in stored.columns))

    return both.select(*[pick(c).alias(c) for c in dict.fromkeys([*stored.columns, *last.columns])])


def upsert_unique(stored: DataFrame, written: DataFrame, keys: list[str], unique: list[list[str]], seq: str) -> tuple[DataFrame, DataFrame]:
    """(stored rows after an upsert, keys that were not there before). A stored row that holds a written row's values of a
    unique column group under another key gives way; of written rows with equal unique values the last stays."""
    rest = [c for c in written.columns if c not in keys and c != seq]
    last = written.groupBy(*keys).agg(F.max(seq).alias(seq), F.max_by(F.struct(*rest), seq).alias("__row")).select(*keys, seq, "__row.*")
    held = stored.join(last.select(*keys), keys, "left_anti")
    for group in unique:
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group])
        winners = last.where(whole).groupBy(*group).agg(F.max_by(F.struct(*keys), seq).alias("__key"))
        winners = winners.select(*group, *[F.col(f"__key.{k}").alias(f"__{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
        last = last.join(winners, group, "left").where(F.col(f"__{keys[0]}").isNull() | same).drop(*[f"__{k}" for k in keys])
        held = held.join(last.where(whole).select(*group), group, "left_anti")
    after = held.unionByName(last.select(*keys, *rest), allowMissingColumns=True).select(*dict.fromkeys([*stored.columns, *keys, *rest]))
    return after, last.select(*keys).join(stored.select(*keys), keys, "left_anti")


#: Characters of a payload from which on it is stored compressed.
COMPRESS_FROM = 5000


def compressed(records: DataFrame, column: str, longest: int = COMPRESS_FROM) -> DataFrame:
    """Payloads over the bound compressed, the rest as they are; Python gets null for the latter."""
    return records.withColumn(column, F.coalesce(deflate(F.when(F.length(column) > longest, F.col(column))), column))


def load(rows: DataFrame, entity: str, key: str, transform: Callable[[DataFrame], DataFrame] | None = None, partitions: int = 10) -> tuple[DataFrame, DataFrame]:
    """(records with `partition` and `id`, rows without a key)."""
    shaped = transform(rows) if transform else rows
    bad = shaped.where(F.col(key).isNull() | (F.col(key).cast("string") == ""))
    good = shaped.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return good.select(entity_partition(entity, F.col(key), partitions).alias("partition"), F.col(key).alias("id"), *[c for c in shaped.columns if c != key]), bad


def get(records: DataFrame, entity: str, key, partitions: int = 10) -> DataFrame:
    """The record of one key; the partition is part of the filter, so that a partitioned table is pruned."""
    part = records.sparkSession.range(1).select(entity_partition(entity, F.lit(key), partitions).alias("p")).first()["p"]
    return records.where((F.col("partition") == part) & (F.col("id") == key))
