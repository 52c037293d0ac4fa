"""Adapters: anything that can be loaded as a DataFrame can be ranged, paged, checksummed, sampled and pruned."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions.predicates import id_limit
from tallyweave.operators import domain, reconcile


class Adapter(ABC):
    """A table with an id column and the fields to compare. `load` is all that a adapter must define."""

    def __init__(self, spark: SparkSession, key: str, fields: list[str], extract_id: Callable[[Column], Column] | None = None):
        self.spark, self.key, self.fields, self.extract_id = spark, key, fields, extract_id

    @abstractmethod
    def load(self) -> DataFrame: ...

    def rows(self, ids: list | None = None, start=None, end=None) -> DataFrame:
        key = self.extract_id(F.col(self.key)) if self.extract_id else F.col(self.key)
        return self.load().where(id_limit(key, ids, start, end))

    def initialize(self) -> dict:
        return {}

    def destroy(self) -> None:
        return None

    def batch(self, start=None, end=None) -> DataFrame:
        return reconcile.batch(self.rows(None, start, end), self.key, self.fields)

    def individual(self, start=None, end=None) -> DataFrame:
        return reconcile.individual(self._keyed(self.rows(None, start, end)), self.key, self.fields)

    def range(self, start=None, end=None) -> DataFrame:
        return reconcile.id_range(self._keyed(self.rows(None, start, end)), self.key)

    def nibble(self, limit: int, start=None, end=None, reverse: bool = False) -> DataFrame:
        bound = lambda x: None if x is None else (x,)
        return reconcile.nibble(self._keyed(self.load()), [self.key], limit, bound(start), bound(end), reverse)

    def get_ids(self, start=None, end=None, reverse: bool = False) -> DataFrame:
        return self._keyed(self.rows(None, start, end)).select(self.key).orderBy(F.col(self.key).desc() if reverse else self.key)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """Rows with the id that `extract_id` makes of the key, in its column."""
        return rows.withColumn(self.key, self.extract_id(F.col(self.key))) if self.extract_id else rows

    def sample(self, ids: list) -> DataFrame:
        return self.rows(ids).select(self.key, *[f for f in self.fields if f != self.key]).orderBy(self.key)

    def delete(self, ids: DataFrame | None = None, **where) -> DataFrame:
        """The table without these rows; the caller publishes it."""
        return reconcile.delete_ids(self.load(), self.key, ids, **where)

    def describe(self) -> T.StructType:
        return self.load().schema

    def stream_changes(self, **_) -> DataFrame:
        """Changes of the table as a stream; a kind of table that has any overrides this."""
        raise NotImplementedError(f"{type(self).__name__} has no change stream")

    def domain_objects(self, ids: DataFrame, joins: list[Callable[[DataFrame], DataFrame]] = (), **more) -> DataFrame:
        return domain.objects(ids, self.key, self.load(), list(joins), **more)

    def snapshot(self, limit: int, path: str, done: list[int] | None = None) -> DataFrame:
        return domain.write_snapshot(self.load(), self.key, limit, path, done)

    #: Names a request may ask for.
    METHODS = ("batch", "individual", "range", "nibble", "sample", "delete", "initialize", "destroy")

    def handle(self, method: str, **arguments):
        if method not in self.METHODS:
            raise ValueError("Invalid Method")
        return getattr(self, method)(**arguments)


class TableAdapter(Adapter):
    """A DataFrame, or what makes one."""

    def __init__(self, spark: SparkSession, table: DataFrame | Callable[[SparkSession], DataFrame], key: str, fields: list[str], **more):
        super().__init__(spark, key, fields, **more)
        self._table = table

    def load(self) -> DataFrame:
        return self._table(self.spark) if callable(self._table) else self._table


class FileAdapter(Adapter):
    """Files of any format Spark reads."""

    def __init__(self, spark: SparkSession, path: str, key: str, fields: list[str], fmt: str = "parquet", schema: T.StructType | None = None, **more):
        super().__init__(spark, key, fields, **more)
        self.path, self.fmt, self.schema = path, fmt, schema

    def load(self) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        return (reader.schema(self.schema) if self.schema else reader).load(self.path)


# JDBC drivers and URL forms of the databases.
JDBC = {
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}"),
    "postgres": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
    "redshift": ("com.amazon.redshift.jdbc42.Driver", "jdbc:redshift://{host}:{port}/{database}"),
    "sqlserver": ("com.microsoft.sqlserver.jdbc.SQLServerDriver", "jdbc:sqlserver://{host}:{port};databaseName={database}"),
    "oracle": ("oracle.jdbc.OracleDriver", "jdbc:oracle:thin:@//{host}:{port}/{database}"),
}


class JdbcAdapter(Adapter):
    """A query in a database. The driver's jar must be on the class path; credentials are passed in, never kept here.

    With bounds the scan is split into ranges of the id column, one task each.
    """

    def __init__(self, spark: SparkSession, kind: str, host: str, port: int, database: str, query: str, key: str, fields: list[str], user: str = "", password: str = "", bounds: tuple[int, int] | None = None, partitions: int = 16, **more):
        super().__init__(spark, key, fields, **more)
        driver, url = JDBC[kind]
        self.kind = kind
        self.options = {"driver": driver, "url": url.format(host=host, port=port, database=database), "user": user, "password": password, "fetchsize": "10000"}
        if bounds:
            self.options |= {"dbtable": f"({query}) t", "partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
        else:
            self.options["query"] = query

    def load(self) -> DataFrame:
        rows = self.spark.read.format("jdbc").options(**self.options).load()
        return rows.toDF(*[c.lower() for c in rows.columns]) if self.kind == "oracle" else rows

    def write(self, df: DataFrame, table: str, mode: str = "append", batch: int = 10000) -> None:
        keep = {k: v for k, v in self.options.items() if k in ("driver", "url", "user", "password")}
        df.write.format("jdbc").options(**keep, dbtable=table, batchsize=str(batch)).mode(mode).save()


class DocumentAdapter(Adapter):
    """A collection of documents (JSON files, or what makes a frame): a condition over them, a projection, and a mapper that
    makes none or one row of each document."""

    def __init__(self, spark: SparkSession, documents: str | Callable[[SparkSession], DataFrame], key: str, fields: list[str], where: str | None = None, mapper: Callable[[dict], dict | None] | None = None, schema: str | None = None, **more):
        super().__init__(spark, key, fields, **more)
        self.documents, self.where, self.mapper, self.mapped_schema = documents, where, mapper, schema

    def load(self) -> DataFrame:
        rows = self.documents(self.spark) if callable(self.documents) else self.spark.read.json(self.documents)
        rows = rows.where(self.where) if self.where else rows
        return mapped(rows, self.mapper, self.mapped_schema) if self.mapper else rows

    def find(self, start=None, end=None) -> DataFrame:
        """The projected documents of a range, by id."""
        return self.rows(None, start, end).select(self.key, *[f for f in self.fields if f != self.key]).orderBy(self.key)


def mapped(rows: DataFrame, mapper: Callable[[dict], dict | None], schema: str) -> DataFrame:
    """What a function makes of each row as a dict; None leaves the row out. In batches, as the function is the caller's own."""
    names = [f.name for f in rows.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [x for x in map(mapper, batch.to_dict("records")) if x is not None]
            yield pd.DataFrame([[x.get(n) for n in names] for x in made], columns=names)

    return rows.mapInPandas(run, schema)


class CustomAdapter(Adapter):
    """Handlers of the caller's own by name; what is not given is derived from `load`."""

    def __init__(self, spark: SparkSession, key: str, fields: list[str], load: Callable[[], DataFrame], **handlers: Callable):
        super().__init__(spark, key, fields)
        self._load = load
        unknown = set(handlers) - set(self.METHODS)
        if unknown:
            raise ValueError(f"no such handlers: {sorted(unknown)}")
        for name, handler in handlers.items():
            setattr(self, name, handler)

    def load(self) -> DataFrame:
        return self._load()


class MockAdapter(Adapter):
    """Ids 1..n whose values are drawn from a seed, some of them wrong: for tests of callers."""

    def __init__(self, spark: SparkSession, n: int, seed: int = 0, wrong_every: int = 0):
        super().__init__(spark, "id", ["value"])
        self.n, self.seed, self.wrong_every = n, seed, wrong_every

    def load(self) -> DataFrame:
        rows = self.spark.range(1, self.n + 1).withColumn("value", F.xxhash64("id", F.lit(self.seed)))
        return rows.withColumn("value", F.when(F.col("id") % self.wrong_every == 0, -F.col("value")).otherwise(F.col("value"))) if self.wrong_every else rows


def compare(master: Adapter, slave: Adapter) -> DataFrame:
    return reconcile.classify(master.individual(), slave.individual())
