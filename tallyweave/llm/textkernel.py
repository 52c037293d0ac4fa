"""Vectorised text kernels: code points, character classes, word hashes and n-grams of many texts at once; and the columns
that operators over whole texts carry along.

Everything works on chunks of a bounded number of characters; only a single text longer than the bound makes a
longer chunk. Hashes depend on the characters alone, so every worker and every rerun gets the same ones.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters worked on at once.
CHUNK_CHARS = 1 << 19
#: Character classes.
SPACE, LETTER, UPPER, DIGIT, OTHER = 0, 1, 2, 3, 4
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point, from its Unicode category. Marks count as letters: they belong to words."""
    by = {"L": LETTER, "M": LETTER, "N": DIGIT, "Z": SPACE}
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind in ("Cn", "Co", "Cs"):
            continue
        table[code] = UPPER if kind in ("Lu", "Lt") else by.get(kind[0], OTHER)
    table[[9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85]] = SPACE
    return table


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter by itself: marks are not."""
    table = np.zeros(0x110000, dtype=bool)
    for code in range(0x110000):
        table[code] = unicodedata.category(chr(code))[0] == "L"
    return table


@functools.lru_cache(maxsize=1)
def _powers_cache() -> dict:
    return {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = _powers_cache()
    if len(cache.get("up", ())) < n:
        size = max(n, CHUNK_CHARS + 2)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            cache[name] = np.cumprod(steps, dtype=np.uint64)
    return cache["up"][:n], cache["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunked(texts: list) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) with at most CHUNK_CHARS characters together, or one text. None counts as ''."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > CHUNK_CHARS:
            yield start, held
            start, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by one line feed, and where each text starts (one more for the end)."""
    joined = "\n".join(texts) + "\n"
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def span_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[b:e] for each span, all at once, by a polynomial with an invertible base."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * down[: len(values)], out=total[1:])
    return mix((total[ends] - total[begins]) * up[begins] + (ends - begins).astype(np.uint64))


class Words:
    """The words (runs of letters, marks and digits, in lower case) of a chunk of texts."""

    def __init__(self, texts: list[str]):
        self.points, starts = code_points([t.lower() for t in texts])
        # lower() can change lengths, so starts are those of the lowered texts
        kind = classes()[self.points]
        self.begins, self.ends = runs((kind == LETTER) | (kind == DIGIT) | (kind == UPPER))
        self.hashes = span_hashes(self.points, self.begins, self.ends)
        #: First word of each text, and one more for the end.
        self.firsts = np.searchsorted(self.begins, starts)
        self.starts = starts

    def word(self, i: int) -> str:
        return self.points[self.begins[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` consecutive words of one text; a shorter text is one shingle, an empty one has none."""
    n = len(hashes)
    if n == 0:
        return hashes
    wide = min(size, n)
    out = np.zeros(n - wide + 1, dtype=np.uint64)
    for k in range(wide):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : n - wide + 1 + k]
    return mix(out + np.uint64(wide))


class Tokens:
    """The tokens between white space of a chunk of texts, with their hashes and character classes."""

    def __init__(self, texts: list[str]):
        self.points, self.starts = code_points(texts)
        self.kind = classes()[self.points]
        self.begins, self.ends = runs(self.kind != SPACE)
        self.hashes = span_hashes(self.points, self.begins, self.ends)
        self.firsts = np.searchsorted(self.begins, self.starts)

    def token(self, i: int) -> str:
        return self.points[self.begins[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")

    def shapes(self) -> np.ndarray:
        """Hash of each token's shape: runs of upper and lower case letters, digits and equal signs count once."""
        symbol = np.where(self.kind == OTHER, self.points, self.kind.astype(np.uint32))
        keep = np.ones(len(symbol), dtype=bool)
        keep[1:] = symbol[1:] != symbol[:-1]
        keep[self.begins] = True
        at = np.cumsum(keep)
        return span_hashes(symbol[keep], at[self.begins] - 1, at[self.ends - 1])


def unused(name: str, columns: list[str]) -> str:
    """`name`, with as many underscores before it as it takes to be no column's name in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_text(docs: DataFrame, keep: list[str], text: str, results: dict[str, str]) -> tuple[DataFrame, T.StructType]:
    """(the columns `keep` and the text last, the schema of what is kept and the results by name and type).

    Kept columns give way to results of the same name in any case; the text's column has a name that none of them has.
    """
    own = {name.lower() for name in results}
    kept = [c for c in keep if c.lower() not in own]
    source = docs.select(*kept, docs[text].alias(unused("__text", docs.columns)))
    ends = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in results.items()]
    return source, T.StructType([T.StructField(f.name, f.dataType) for f in source.schema.fields[:-1]] + ends)
