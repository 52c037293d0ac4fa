"""Language of a text by rank-order profiles.

A text's letters are lowered, everything else parts words, and n-grams of one to three characters are counted within
words padded by one space. A profile is the PROFILE_SIZE most frequent n-grams in order. A text is in the language
whose profile is nearest by out-of-place distance: the sum over the text's n-grams of how far their ranks lie apart,
PROFILE_SIZE where the language's profile has no such n-gram.

Profiles are counted over all texts to learn from. Counts are sums, so they do not depend on the order of rows; equal
counts rank by the n-gram's code points, equal distances go to the smaller language name.

Null text or text without any letter (marks are none): `und` with score 0. Very long texts are read whole. Rows are
independent of each other, so repeated rows give repeated results. An empty table to learn from gives a model that
answers `und`; an empty table to identify gives an empty result. Kept columns named lang_pred or score give way to the
result's own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.textkernel import LETTER, UPPER, chunked, classes, code_points, letters, with_text

PROFILE_SIZE = 300
UNKNOWN = "und"
#: Distinct n-grams a task holds for a language before it passes them on.
HELD = 1 << 20


class Grams:
    """The n-grams of a chunk of texts, packed into 63 bits: 21 for each character."""

    def __init__(self, texts: list[str]):
        points, starts = code_points([t.lower() for t in texts])
        kind = classes()[points]
        letter = (kind == LETTER) | (kind == UPPER)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of each run of other characters stays, as a space
        keep[0] = letter[0]
        codes = np.where(letter, points, 32)[keep].astype(np.int64)
        self.codes = np.concatenate(([32], codes, [32, 32]))
        count = np.concatenate(([0], np.cumsum(keep)))
        # marks stand in words, but a text of marks alone has no letter
        pure = np.concatenate(([0], np.cumsum(letters()[points])))
        has = pure[starts[1:]] > pure[starts[:-1]]
        # positions before each text's first letter and after its last
        firsts, lasts = np.searchsorted(at := np.flatnonzero(letter), starts[:-1]), np.searchsorted(at, starts[1:])
        self.spans = [(count[at[a]], count[at[b - 1]] + 2) if yes else None for a, b, yes in zip(firsts, lasts, has)]
        c = self.codes
        self.two = (c[:-1] << 21) | c[1:]
        self.three = (self.two[:-1] << 21) | c[2:]
        self.inner = c[1:-1] != 32

    def of(self, i: int) -> np.ndarray:
        """All n-grams of text i, as often as they occur."""
        if self.spans[i] is None:
            return np.zeros(0, dtype=np.int64)
        a, b = self.spans[i]
        one = self.codes[a:b]
        return np.concatenate((one[one != 32], self.two[a : b - 1], self.three[a : b - 1][self.inner[a : b - 1]]))


def ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent n-grams, most frequent first."""
    found, counts = np.unique(grams, return_counts=True)
    if len(found) > 4 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.lexsort((found, -counts))[:size]]


class Profiles:
    """The ranks of all languages' n-grams."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.languages, self.size = sorted(profiles), size
        self.known = np.unique(np.concatenate([np.array(profiles[name], dtype=np.int64) for name in self.languages] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.languages), len(self.known) + 1), size, dtype=np.int64)
        for k, name in enumerate(self.languages):
            self.ranks[k, np.searchsorted(self.known, np.array(profiles[name], dtype=np.int64))] = np.arange(len(profiles[name]))

    def predict(self, grams: np.ndarray) -> tuple[str, float]:
        """(language, score). The score is how much farther the second language is than the nearest, from 0 to 1."""
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        top = ranked(grams, self.size)
        at = np.searchsorted(self.known, top)
        at[self.known[np.minimum(at, len(self.known) - 1)] != top] = len(self.known)
        ranks = self.ranks[:, at]
        away = np.where(ranks < self.size, np.abs(ranks - np.arange(len(top))), self.size).sum(axis=1)
        best = int(np.argmin(away))
        if len(away) == 1:
            return self.languages[0], float(1 - away[0] / (self.size * len(top)))
        second = np.partition(away, 1)[1]
        return self.languages[best], float((second - away[best]) / second) if second else 0.0


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of all languages in column `lang`, counted over every row where it is not null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, texts in chunked(batch.column(1).to_pylist()):
                grams = Grams(texts)
                by: dict[str, list] = defaultdict(list)
                for i in range(len(texts)):
                    by[names[at + i]].append(grams.of(i))
                for name, found in by.items():
                    held[name].append(np.unique(np.concatenate(found), return_counts=True))
                    if sum(len(x) for x, _ in held[name]) > HELD:
                        held[name] = [_added(held[name])]
                        if len(held[name][0][0]) > HELD // 2:
                            yield _rows(name, held.pop(name)[0])
        for name, parts in held.items():
            yield _rows(name, _added(parts))

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).mapInArrow(count, "lang string, gram long, n long")
    totals = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # the size of what comes back is PROFILE_SIZE rows for each language
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).collect()
    profiles: dict[str, list[int]] = defaultdict(list)
    for row in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles[row["lang"]].append(row["gram"])
    return Profiles(profiles, size)


def _added(parts: list) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _rows(name: str, counted: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    grams, counts = counted
    return pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


def identify(docs: DataFrame, model: Profiles, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, lang_pred and score. One pass without a shuffle; the broadcast model is PROFILE_SIZE n-grams a language."""
    source, schema = with_text(docs, keep, text, {"lang_pred": "string", "score": "double"})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunked(batch.column(batch.num_columns - 1).to_pylist()):
                grams = Grams(texts)
                found = [shared.value.predict(grams.of(i)) for i in range(len(texts))]
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return source.mapInArrow(run, schema)
