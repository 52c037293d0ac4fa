"""Paged and per-method HTTP sources as Python data sources, and a bulk sink: for search services and remote adapters.

`fetch` and `post` are injected, so tests use functions instead of a network.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE, MOST = 10_000, 100_000
BULK_ROWS, BULK_BYTES = 1000, 9_500_000


def post_json(url: str, body: dict | str, timeout: int = 60) -> dict:
    data = (body if isinstance(body, str) else json.dumps(body)).encode()
    request = urllib.request.Request(url, data, {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.load(answer)


class ScrollSource(DataSource):
    """Hits of a search, page after page. Options: url, query (JSON), size, max, slices. Slices are not equally full, so each
    may read up to `max`: with several of them limit() the frame to it."""

    @classmethod
    def name(cls) -> str:
        return "scroll"

    def schema(self) -> str:
        return "_id string, source string"

    def reader(self, schema) -> DataSourceReader:
        return _ScrollReader(dict(self.options), post_json)


class _ScrollReader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable[[str, dict], dict]):
        self.options, self.fetch = options, fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(int(self.options.get("slices", 1)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        slices = int(self.options.get("slices", 1))
        return scroll(self.fetch, self.options["url"], json.loads(self.options.get("query", "{}")), int(self.options.get("size", PAGE)), int(self.options.get("max", MOST)), (partition.value, slices))


def scroll(fetch: Callable[[str, dict], dict], url: str, query: dict, size: int = PAGE, most: int = MOST, part: tuple[int, int] = (0, 1), give: str | Callable[[dict], tuple | None] = "source", found: Callable[[dict], None] | None = None) -> Iterator[tuple]:
    """Hits until there are no more or `most` have been read. `give` says what of a hit: "source" (id, source as JSON), "full"
    (id, the whole hit as JSON), or a function of the hit, whose None leaves it out. `found` gets the answer's aggregations."""
    whole = give if callable(give) else (lambda hit: (hit["_id"], json.dumps(hit if give == "full" else hit.get("_source", {}))))
    body = {"size": min(size, most), **query} | ({"slice": {"id": part[0], "max": part[1]}} if part[1] > 1 else {})
    answer, read = fetch(url, body), 0
    while True:
        if found and "aggregations" in answer:
            found(answer["aggregations"])
        hits = answer.get("hits", {}).get("hits", [])
        for hit in hits[: most - read]:
            row = whole(hit)
            if row is not None:
                yield row
        read += len(hits)
        if not hits or read >= most or "_scroll_id" not in answer:
            return
        answer = fetch(url, {"scroll_id": answer["_scroll_id"]})


def search(fetch: Callable[[str, dict], dict], url: str, query: dict) -> dict:
    """The plain answer to one search."""
    return fetch(url, query)


def aggregations(fetch: Callable[[str, dict], dict], url: str, query: dict, aggs: dict) -> dict:
    """The aggregations of a search as the service gives them."""
    return fetch(url, {**query, "aggs": aggs, "size": 0}).get("aggregations", {})


def ids_of(fetch: Callable[[str, dict], dict], url: str, queries: list[dict], size: int = PAGE, most: int = MOST) -> Iterator[str]:
    """Ids that the queries find, one query after another."""
    for query in queries:
        yield from (hit for hit, in scroll(fetch, url, {**query, "_source": False}, size, most, give=lambda h: (h["_id"],)))


def remote(spark: SparkSession, url: str, method: str, arguments: dict, schema: str, fetch: Callable[[str, dict], dict] = post_json, after: Callable[[dict], list] | None = None) -> DataFrame:
    """Rows that a remote table answers a method with; a task fetches them, the driver only knows their schema."""
    names = [f.name for f in spark.createDataFrame([], schema).schema]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _ in range(len(batch)):
                answer = fetch(url, {"method": method, **arguments})
                yield pd.DataFrame(after(answer) if after else answer["rows"], columns=names)

    return spark.range(1, numPartitions=1).mapInPandas(ask, schema)


def bulk_lines(rows: Iterator, index: str, key: str = "id", deleted: str = "deleted") -> Iterator[str]:
    """Bulk requests of at most BULK_ROWS rows and about BULK_BYTES: upserts of documents, and deletes."""
    while chunk := list(islice(rows, BULK_ROWS)):
        lines, size = [], 0
        for row in chunk:
            data = row.asDict(True)
            head = {"_index": index, "_id": data.pop(key)}
            own = [json.dumps({"delete": head})] if data.pop(deleted, False) else [json.dumps({"update": head}), json.dumps({"doc": data, "doc_as_upsert": True}, default=str)]
            if lines and size + sum(map(len, own)) > BULK_BYTES:
                yield "\n".join(lines) + "\n"
                lines, size = [], 0
            lines += own
            size += sum(map(len, own))
        if lines:
            yield "\n".join(lines) + "\n"


def bulk_write(df: DataFrame, url: str, index: str, key: str = "id", parallel: int = 8, post: Callable[[str, str], dict] = post_json, tries: int = 2) -> None:
    """Rows to a search service, from at most `parallel` tasks at once; errors in an answer fail the task."""

    def send(rows: Iterator) -> None:
        for body in bulk_lines(rows, index, key):
            for attempt in range(tries):
                if not post(url, body).get("errors"):
                    break
                if attempt == tries - 1:
                    raise RuntimeError(f"bulk request to {index} had errors")

    # a shuffle of its own, so that what comes before keeps its tasks
    df.repartition(parallel).foreachPartition(send)
