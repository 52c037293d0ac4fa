"""Change feeds kept as files, as streams or batches that begin after a position: row logs, logical decoding, document logs.

A stream's checkpoint holds which files have been read, so a run that is started again goes on where the last one stopped;
`after` is the position to begin from at first. The batch forms read the same files at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyweave.operators import changes
from tallyweave.sources import storage

#: A row event: `key` is the primary key's value, null for a table without one.
ROWS = "position bigint, ts timestamp, kind string, schema string, table string, key string"
DOCUMENTS = "position bigint, ts timestamp, op string, ns string, id string"


def _read(spark: SparkSession, path: str, schema: str, stream: bool, files: int | None):
    reader = (spark.readStream if stream else spark.read).schema(schema)
    return reader.option("maxFilesPerTrigger", files) if stream and files else reader


def row_log(spark: SparkSession, path: str, after: int | None = None, include: list[str] | None = None, exclude: list[str] | None = None, until=None, stream: bool = False, files: int | None = None) -> DataFrame:
    """(op, schema, table, id, position, ts) of row events after a position and before a time. Schemas can be named or left
    out; tables without a primary key give nothing, as no consumer could ask for their rows."""
    rows = _read(spark, path, ROWS, stream, files).json(path).where("key is not null")
    rows = rows if after is None else rows.where(F.col("position") > after)
    rows = rows.where(F.col("schema").isin(*include)) if include else rows
    rows = rows.where(~F.col("schema").isin(*exclude)) if exclude else rows
    rows = rows if until is None else rows.where(F.col("ts") < F.lit(str(until)).cast("timestamp"))
    return rows.select(changes.operation(F.col("kind")).alias("op"), "schema", "table", F.col("key").alias("id"), "position", "ts").where("op is not null")


def decoded_log(spark: SparkSession, path: str, after: str | None = None, stream: bool = False, files: int | None = None) -> DataFrame:
    """Decoded lines (`position`, a tab, the line) past a log position."""
    lines = _read(spark, path, "value string", stream, files).text(path)
    rows = lines.select(F.substring_index("value", "\t", 1).alias("lsn"), F.expr("substring(value, instr(value, '\t') + 1)").alias("value"))
    return changes.decode(rows if after is None else changes.after_lsn(rows, "lsn", after))


def document_log(spark: SparkSession, path: str, after: int | None = None, where: str | None = None, stream: bool = False, files: int | None = None) -> DataFrame:
    """Document events (position, ts, op, ns, id) after a position that a filter keeps."""
    rows = _read(spark, path, DOCUMENTS, stream, files).json(path)
    rows = rows if after is None else rows.where(F.col("position") > after)
    rows = rows.where(where) if where else rows
    return rows.withColumn("op", changes.operation(F.col("op"))).where("op is not null")


def folded(stream: DataFrame, root: str, checkpoint: str, size: int = 10_000) -> StreamingQuery:
    """Each micro-batch's ids by table and operation, a version of pages under `root` for each; a batch run again replaces its own."""

    def each(rows: DataFrame, batch: int) -> None:
        storage.write_version(changes.fold_pages(rows, ["id"], size), root, batch)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tail(stream: DataFrame, current: Callable[[SparkSession], DataFrame], root: str, checkpoint: str, handler=None, schema: str | None = None) -> StreamingQuery:
    """Each micro-batch's changed documents as they are now, or as deletes, through a handler if given: a version for each."""

    def each(rows: DataFrame, batch: int) -> None:
        storage.write_version(changes.enrich(rows, current(rows.sparkSession), "id", "op", "position", handler, schema), root, batch)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def enrich_ids(spark: SparkSession, path: str, current: DataFrame, kind: str = "long", handler=None, schema: str | None = None) -> DataFrame:
    """The bulk form: ids from files, a line each, as if each had been updated."""
    ids = spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").select(F.col("id").cast(kind)).distinct()
    return changes.enrich(ids.select("id", F.lit("update").alias("op"), F.lit(0).alias("position")), current, "id", "op", "position", handler, schema)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """All complete versions under `root`, with their number as `batch`."""
    out = None
    for n in storage.versions(spark, root):
        one = spark.read.parquet(f"{root}/version-{n}").withColumn("batch", F.lit(n))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise FileNotFoundError(f"no complete version under {root}")
    return out
