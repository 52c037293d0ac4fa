"""File sources and sinks: delimited copies, id files, quarantined and published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.scalars import for_load
from tallyweave.sources.storage import versions, write_version


def copy_out(df: DataFrame, path: str, columns: list[str] | None = None, where: Column | None = None, delimiter: str = "|", null: str = "\\N", header: bool = False) -> None:
    """Delimited text; line breaks within values are escaped, so that a line is a row."""
    rows = df if where is None else df.where(where)
    text = [F.regexp_replace(F.regexp_replace(F.col(c), r"\\", r"\\\\"), "\n", r"\\n").alias(c) if dict(df.dtypes)[c] == "string" else F.col(c) for c in columns or df.columns]
    rows.select(*text).write.mode("overwrite").option("sep", delimiter).option("nullValue", null).option("emptyValue", "").option("header", header).csv(path)


def copy_in(spark: SparkSession, path: str | list[str], schema: str, delimiter: str = "|", null: str = "\\N", header: bool = False) -> DataFrame:
    """Delimited text as a warehouse loads it: '' is null, carriage returns become line feeds."""
    rows = spark.read.schema(schema).option("sep", delimiter).option("nullValue", null).option("header", header).csv(path)
    return rows.select(*[for_load(F.col(c)).alias(c) if kind == "string" else F.col(c) for c, kind in rows.dtypes])


def id_file(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """One id a line; empty lines count for nothing."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").select(F.col("id").cast(kind))


def quarantine(rejected: DataFrame, source: str, path: str) -> None:
    """Rejected events with their errors, as JSON, under the source's error name."""
    rejected.withColumn("queue", F.lit(f"{source}_error")).write.mode("append").json(f"{path}/{source}_error")


def publish(df: DataFrame, root: str, version: int) -> str:
    """A new version of a table. Readers take the greatest complete one, so they see the old or the new, never a part."""
    return write_version(df, root, version)


def published(spark: SparkSession, root: str) -> DataFrame:
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root}/version-{found[-1]}")


def unload(df: DataFrame, path: str, columns: list[str] | None = None, where: Column | None = None, delimiter: str = "|") -> DataFrame:
    """Delimited files with a manifest of them; gives the manifest (url, bytes)."""
    copy_out(df, f"{path}/data", columns, where, delimiter)
    spark = df.sparkSession
    listed = spark.read.format("binaryFile").load(f"{path}/data").where("length > 0").select(F.col("path").alias("url"), F.col("length").alias("bytes"))
    listed.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema("url string, bytes long").json(f"{path}/manifest")


def load_manifest(spark: SparkSession, path: str, schema: str, delimiter: str = "|") -> DataFrame:
    """The rows of exactly the files that a manifest lists."""
    urls = [r["url"] for r in spark.read.schema("url string, bytes long").json(f"{path}/manifest").collect()]
    return copy_in(spark, urls, schema, delimiter) if urls else spark.createDataFrame([], schema)
