"""The bucketed aggregator and entity loader on streams.

Each micro-batch is folded, merged with the stored rows of the parts it touches and written as a new version under the
batch's number. A batch that is run again starts from the version before it, so replays change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyweave.operators import aggregates, entity
from tallyweave.sources import storage

_KEYS = "id string, category string, bucket string"


class Store:
    """A keyed state table in `parts` folders by hash of the id. A batch rewrites only the parts it touches; its manifest, the
    last thing written, says under which batch each part stands. A manifest counts once it is complete: after a crash at any
    point the state is that of the last complete batch, and the batch runs again from there. Older versions go."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 16):
        self.spark, self.root, self.parts = spark, root, parts

    def part_of(self, column: str = "id") -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(self.parts)).cast("int")

    def version(self) -> int:
        found = storage.versions(self.spark, f"{self.root}/manifest")
        return found[-1] if found else -1

    def _places(self, batch: int) -> dict[int, int]:
        if batch < 0:
            return {}
        return {r["part"]: r["batch"] for r in self.spark.read.schema("part int, batch long").json(f"{self.root}/manifest/version-{batch}").collect()}

    def read(self, batch: int, parts: list[int] | None = None) -> DataFrame | None:
        """The state after a batch, or some parts of it; None if nothing is there."""
        paths = [f"{self.root}/data/version-{at}/__part={p}" for p, at in self._places(batch).items() if parts is None or p in parts]
        return self.spark.read.parquet(*paths) if paths else None

    def write(self, df: DataFrame, batch: int, touched: list[int], key: str = "id") -> None:
        """The touched parts' new rows, then the manifest."""
        before = self.version()
        df.withColumn("__part", self.part_of(key)).repartition(len(touched) or 1, "__part").write.mode("overwrite").partitionBy("__part").parquet(f"{self.root}/data/version-{batch}")
        places = self._places(before) | {p: batch for p in touched}
        manifest = self.spark.createDataFrame(sorted(places.items()), "part int, batch long").coalesce(1)
        storage.write_version(manifest, f"{self.root}/manifest", batch, "json", keep=2)
        # the manifest before this one still serves a reader
        used = set(places.values()) | set(self._places(before).values())
        for old in storage.versions(self.spark, f"{self.root}/data"):
            if old not in used:
                storage.remove(self.spark, f"{self.root}/data/version-{old}")

    def apply(self, rows: DataFrame, batch: int, step: Callable[[DataFrame | None, DataFrame], DataFrame], key: str = "id") -> bool:
        """The state after `step(stored rows of the touched parts, rows)`; False if the batch is there already."""
        before = self.version()
        if before >= batch:
            return False
        rows = rows.persist()
        try:
            # at most `parts` numbers
            touched = sorted(r["part"] for r in rows.select(self.part_of(key).alias("part")).distinct().collect())
            if touched or before < 0:
                self.write(step(self.read(before, touched), rows), batch, touched, key)
            else:
                storage.write_version(self.spark.createDataFrame(sorted(self._places(before).items()), "part int, batch long").coalesce(1), f"{self.root}/manifest", batch, "json", keep=2)
        finally:
            rows.unpersist()
        return True


def aggregate_batch(store: Store, rows: DataFrame, batch: int, buckets: list[str], value: str, ts: str, seq: str, is_old: str | None = None) -> None:
    """One batch into the store; a batch already there is not added twice."""
    part = aggregates.partial(aggregates.with_buckets(rows, ts, buckets), value, ts, seq, is_old)
    store.apply(part, batch, lambda stored, new: aggregates.merged(stored.drop("p") if stored is not None else new.limit(0), new))


def aggregator(stream: DataFrame, root: str, checkpoint: str, buckets: list[str], value: str, ts: str, seq: str, transform: Callable[[DataFrame], DataFrame] | None = None, is_old: str | None = None) -> StreamingQuery:
    """All that is there now, in micro-batches, then stop: run again to go on."""

    def each(rows: DataFrame, batch: int) -> None:
        aggregate_batch(Store(rows.sparkSession, root), transform(rows) if transform else rows, batch, buckets, value, ts, seq, is_old)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_from_queue(stream: DataFrame, root: str, checkpoint: str, name: str, key: str, seq: str, merge: bool = False, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """A queue of records into an entity table; rows without a key go to the quarantine under `root`, by batch."""

    def each(rows: DataFrame, batch: int) -> None:
        store = Store(rows.sparkSession, f"{root}/records")
        good, bad = entity.load(rows, name, key, transform)
        storage.write_version(bad.withColumn("errors", F.array(F.lit(f"{key}: key missing"))), f"{root}/{name}_error", batch, "json")
        fold = entity.merge if merge else entity.upsert
        store.apply(good, batch, lambda stored, new: fold(stored if stored is not None else new.drop(seq).limit(0), new, ["partition", "id"], seq))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def queue(spark: SparkSession, path: str, schema: str, start: str | None = None, limit: int | None = None, position: str = "position", fmt: str = "json") -> DataFrame:
    """A queue kept as files, as a stream: events after a position, at most `limit` files a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    rows = (reader.option("maxFilesPerTrigger", limit) if limit else reader).load(path)
    return rows if start is None else rows.where(F.col(position) > F.lit(start))


class ChangeCounter(StatefulProcessor):
    """Exact changes of a value per key over any number of batches: the last value is state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "last string, changes long, seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, changes, seen = self.state.get() if self.state.exists() else (None, 0, False)
        for value in pd.concat(list(rows)).sort_values("seq")["value"]:
            changes += int(seen and value != last)
            last, seen = value, True
        self.state.update((last, changes, seen))
        yield pd.DataFrame({"id": [key[0]], "changes": [changes]})

    def close(self) -> None:
        return None


def count_changes(stream: DataFrame) -> DataFrame:
    """(id, changes so far) of a stream (id, value, seq). Needs the RocksDB state store."""
    return stream.groupBy("id").transformWithStateInPandas(ChangeCounter(), "id string, changes long", "update", "None")


def windowed(stream: DataFrame, ts: str, width: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts per window of event time, closed by a watermark."""
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(span.alias("w")).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", "n")
