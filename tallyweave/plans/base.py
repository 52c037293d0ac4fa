"""How query modules register what they have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The driver's tables in a folder, read when named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def register(queries: dict, oracles: dict) -> Callable:
    """@query("SQL") puts a function of Tables under its name, with its oracle."""

    def query(sql: str | None = None) -> Callable:
        def put(f: Callable[[Tables], DataFrame]) -> Callable:
            queries[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql:
                oracles[f.__name__] = sql
            return f

        return put

    return query
