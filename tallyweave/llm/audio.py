"""Chroma fingerprints of audio, and aligning recordings by them.

Samples are cut into overlapping windowed frames; the energy of each frame's spectrum is gathered into twelve pitch
classes and normalised. Over that picture (time by pitch class) FILTERS rectangle filters are laid at each time, each
comparing two halves by sums from an integral image; the logarithm of their ratio is quantised to two bits in Gray code.
The bits of all filters are packed into one 32-bit integer for each time.

Alignment: the upper bits of all filters (which of the two halves is greater) in each run of RUN integers make a landmark,
kept with all its places. Recordings that share landmarks get a histogram of the offsets between them; every offset with VOTES is
checked by the share of different bits over the whole overlap, and of those that pass the one with the most votes counts.

Recordings with equal fingerprints are one class and are compared once. Audio shorter than a frame and the filters has an
empty fingerprint: it is classed by equal samples, and aligns with nothing else. Null, empty and undecodable audio aligns
with nothing. Long recordings are read whole, in blocks of frames. Repeated ids: each row is a recording of its own; a
class counts rows. Null ids are kept as members of classes and are no queries. Ties go to the smaller id, then to the
offset nearest 0. An empty table gives an empty result. Only the columns named are read: others cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import io
import math
import struct
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.neardup import components
from tallyweave.session import cut

RATE, FRAME, HOP, FILTERS, SPAN = 8000, 512, 128, 16, 8
#: Integers in a landmark, and the bits of each that count: the upper one of every filter's two.
RUN, UPPER_BITS = 2, 0xAAAAAAAA
#: An alignment needs this many votes and integers of overlap, and at most this share of different bits: the best of all
#: offsets of unrelated recordings rarely gets below 0.15.
VOTES, OVERLAP, ERRORS = 1, 8, 0.12
_FRAMES_AT_ONCE = 4096


@functools.lru_cache(maxsize=4)
def _pitch_classes(frame: int, rate: int) -> np.ndarray:
    """Matrix from spectrum bins to pitch classes: equal temperament around 440 Hz, bins from 60 Hz up."""
    hertz = np.fft.rfftfreq(frame, 1 / rate)
    out = np.zeros((len(hertz), 12), dtype=np.float32)
    for k, f in enumerate(hertz):
        if f >= 60:
            out[k, round(12 * math.log2(f / 440.0)) % 12] = 1
    return out


def chroma(samples: np.ndarray, rate: int = RATE, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """Frames by twelve pitch classes, each frame of length one (or zero where silent)."""
    if len(samples) < frame:
        return np.zeros((0, 12), dtype=np.float32)
    window = np.hanning(frame).astype(np.float32)
    views = np.lib.stride_tricks.sliding_window_view(samples, frame)[::hop]
    parts = []
    for at in range(0, len(views), _FRAMES_AT_ONCE):
        spectrum = np.fft.rfft(views[at : at + _FRAMES_AT_ONCE] * window, axis=1)
        parts.append((spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ _pitch_classes(frame, rate))
    energy = np.concatenate(parts)
    length = np.sqrt((energy**2).sum(axis=1, keepdims=True))
    return np.where(length > 1e-6, energy / np.maximum(length, 1e-6), 0).astype(np.float32)


@functools.lru_cache(maxsize=1)
def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, classes, times): kinds, heights and widths by turns, so that all of the picture is covered."""
    return [(k % 4, (5 * k) % 9, 4 if k % 2 else 3 + k % 3, (SPAN, SPAN // 2, SPAN, SPAN // 4)[k // 4]) for k in range(FILTERS)]


#: Quartiles of the filters' log ratios on unit-length chroma.
_STEPS = np.array([-0.16, 0.0, 0.16], dtype=np.float32)
_GRAY = np.array([0, 1, 3, 2], dtype=np.uint32)


def fingerprint(samples: np.ndarray, rate: int = RATE, frame: int = FRAME, hop: int = HOP) -> np.ndarray:
    """Packed integers, one for each time at which all filters fit."""
    picture = chroma(samples, rate, frame, hop)
    times = len(picture) - SPAN + 1
    if times <= 0:
        return np.zeros(0, dtype=np.uint32)
    total = np.zeros((len(picture) + 1, 13), dtype=np.float64)
    total[1:, 1:] = picture.cumsum(axis=0, dtype=np.float64).cumsum(axis=1)
    at = np.arange(times)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return total[at + t1, c1] - total[at + t0, c1] - total[at + t1, c0] + total[at + t0, c0]

    out = np.zeros(times, dtype=np.uint32)
    for kind, c, h, w in _filters():
        half_w, half_h = w // 2, h // 2
        if kind == 0:  # earlier against later
            a, b = area(0, half_w, c, c + h), area(half_w, w, c, c + h)
        elif kind == 1:  # lower against higher classes
            a, b = area(0, w, c, c + half_h), area(0, w, c + h - half_h, c + h)
        elif kind == 2:  # crosswise
            a = area(0, half_w, c, c + half_h) + area(half_w, w, c + h - half_h, c + h)
            b = area(half_w, w, c, c + half_h) + area(0, half_w, c + h - half_h, c + h)
        else:  # middle against both ends in time
            third = max(1, w // 3)
            a, b = area(third, w - third, c, c + h), area(0, third, c, c + h) + area(w - third, w, c, c + h)
        ratio = np.log((1 + np.maximum(a, 0)) / (1 + np.maximum(b, 0)))
        out = (out << np.uint32(2)) | _GRAY[np.searchsorted(_STEPS, ratio)]
    return out


def samples_of(data: bytes | None) -> tuple[np.ndarray, int]:
    """(samples between -1 and 1, rate) of WAV bytes (PCM of 8 to 32 bits, channels averaged), else of raw unsigned 8-bit mono
    at RATE. Bytes that begin like a WAV file but are none that can be read have no samples."""
    data = data or b""
    if data[:4] == b"RIFF" and data[8:12] == b"WAVE":
        try:
            with wave.open(io.BytesIO(data)) as file:
                raw, width, channels, rate = file.readframes(file.getnframes()), file.getsampwidth(), file.getnchannels(), file.getframerate()
        except (wave.Error, EOFError, RuntimeError, ValueError, struct.error):
            return np.zeros(0, dtype=np.float32), RATE
        if width not in (1, 2, 3, 4) or channels < 1 or rate < 1:
            return np.zeros(0, dtype=np.float32), RATE
        raw = np.frombuffer(raw[: len(raw) // width * width], dtype=np.uint8).reshape(-1, width)
        if width == 1:
            values = raw[:, 0].astype(np.float32) / 128 - 1
        else:  # little-endian, moved to the high bytes of 32 bits
            wide = np.zeros((len(raw), 4), dtype=np.uint8)
            wide[:, 4 - width :] = raw
            values = (wide.view("<i4")[:, 0] / float(1 << 31)).astype(np.float32)
        return values[: len(values) // channels * channels].reshape(-1, channels).mean(axis=1), rate
    return np.frombuffer(data, dtype=np.uint8).astype(np.float32) / 128 - 1, RATE


def _landmarks(prints: np.ndarray) -> list[tuple[int, int]]:
    """(landmark, its place), in order of both."""
    n = len(prints) - RUN + 1
    if n <= 0:
        return []
    h = np.zeros(n, dtype=np.uint64)
    for k in range(RUN):
        h = (h ^ (prints[k : n + k] & np.uint32(UPPER_BITS)).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    places = np.argsort(h, kind="stable")
    return list(zip(h[places].view(np.int64).tolist(), places.tolist()))


@functools.lru_cache(maxsize=256)
def _places(prints: bytes) -> dict[int, np.ndarray]:
    """Places of each landmark of a fingerprint."""
    out: dict[int, list[int]] = {}
    for value, place in _landmarks(np.frombuffer(prints, dtype=np.uint32)):
        out.setdefault(value, []).append(place)
    return {value: np.array(found, dtype=np.int64) for value, found in out.items()}


def best_offset(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, float] | None:
    """(place, votes, overlap, bit error) of the offset with the most votes, then nearest to 0, of all that pass."""
    left, right = _places(a.tobytes()), _places(b.tobytes())
    votes = np.zeros(len(a) + len(b), dtype=np.int64)
    for value in left.keys() & right.keys():
        for at in left[value]:
            votes[right[value] - at + len(a)] += 1
    offsets = np.flatnonzero(votes >= VOTES) - len(a)
    for place in sorted(offsets.tolist(), key=lambda x: (-votes[x + len(a)], abs(x), -x)):
        x, y = a[max(0, -place) :], b[max(0, place) :]
        overlap = min(len(x), len(y))
        if overlap >= OVERLAP:
            error = int(np.bitwise_count(x[:overlap] ^ y[:overlap]).sum()) / (32.0 * overlap)
            if error <= ERRORS:
                return place, int(votes[place + len(a)]), overlap, error
    return None


def fingerprints(table: DataFrame, key: str, audio: Column) -> DataFrame:
    """(id, prints array<int>, same: digest of the prints, or of the samples where there are none, marks: landmarks)."""
    source = table.select(F.col(key).cast("long").alias("id"), audio.cast("binary").alias("audio"))
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                heard = [samples_of(x.as_py()) for x in batch.column(1)]
                prints = [fingerprint(*x) for x in heard]
                short = [hashlib.md5(x.tobytes() + str(rate).encode()).hexdigest() if len(x) and not len(p) else None for (x, rate), p in zip(heard, prints)]
                marks = [[{"hash": h, "place": p} for h, p in _landmarks(x)] for x in prints]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.view(np.int32) for x in prints], pa.list_(pa.int32())), pa.array(marks, kind), pa.array(short, pa.string())], names=["id", "prints", "marks", "short"])

    rows = source.mapInArrow(run, "id long, prints array<int>, marks array<struct<hash: long, place: int>>, short string")
    return rows.withColumn("same", F.when(F.size("prints") > 0, F.md5(F.array_join("prints", ","))).otherwise(F.concat(F.lit("short "), "short"))).drop("short")


class _Aligned:
    """Recordings by fingerprint, the queries among them, and the aligned pairs of different fingerprints."""

    def __init__(self, table: DataFrame, is_query: Column, key: str, audio: Column):
        self.prints = cut(fingerprints(table, key, audio))
        self.classes = classes = cut(self.prints.where("same is not null").groupBy("same").agg(F.min("id").alias("recording_id"), F.count(F.lit(1)).alias("n"), F.first("prints").alias("prints"), F.first("marks").alias("marks")))
        self.queries = self.prints.where("same is not null and id is not null").where(F.coalesce(is_query, F.lit(False))).select(F.col("id").alias("query_id"), "same")
        asked = self.queries.select("same").distinct()
        marks = classes.select("same", F.explode(F.array_distinct("marks.hash")).alias("hash"))
        left = marks.join(asked, "same", "left_semi").select(F.col("same").alias("q"), "hash")
        met = left.join(marks.select(F.col("same").alias("r"), "hash"), "hash").where("q <> r").select("q", "r").distinct()
        pairs = met.join(classes.select(F.col("same").alias("q"), F.col("prints").alias("pq")), "q").join(classes.select(F.col("same").alias("r"), F.col("prints").alias("pr")), "r")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [best_offset(*(batch.column(k)[i].values.to_numpy().view(np.uint32) for k in (2, 3))) for i in range(batch.num_rows)]
                keep = pa.array([x is not None for x in found], pa.bool_())
                parts = list(zip(*(x for x in found if x is not None))) or [[]] * 4
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).filter(keep) for k in (0, 1)), *(pa.array(x, kind) for x, kind in zip(parts, kinds))], names=["q", "r", "place", "votes", "overlap", "bit_error"])

        self.pairs = cut(pairs.select("q", "r", "pq", "pr").mapInArrow(run, "q string, r string, place int, votes long, overlap int, bit_error double"))

    def alignments(self) -> DataFrame:
        """(same, recording_id, copies, place, votes, overlap, bit_error) for each fingerprint asked for."""
        others = self.pairs.join(self.classes.select(F.col("same").alias("r"), "recording_id", F.col("n").alias("copies")), "r")
        others = others.select(F.col("q").alias("same"), "recording_id", "copies", "place", "votes", "overlap", "bit_error")
        # a query's own class needs no alignment: its other members have equal fingerprints
        own = self.classes.where("n > 1").select("same", "recording_id", (F.col("n") - 1).alias("copies"), F.lit(0).alias("place"), F.size("marks").cast("long").alias("votes"), F.size("prints").alias("overlap"), F.lit(0.0).alias("bit_error"))
        return others.unionByName(own.join(self.queries.select("same").distinct(), "same", "left_semi"))


def align(table: DataFrame, is_query: Column, key: str, audio: Column) -> DataFrame:
    """(query_id, recording_id, copies, place, votes, overlap, bit_error) for each query and each class it aligns with.

    `recording_id` is the least id of the class, `copies` its rows, without the query itself. `place` is how many integers
    later the shared part stands in the recording.
    """
    found = _Aligned(table, is_query, key, audio)
    return found.queries.join(found.alignments(), "same").select("query_id", "recording_id", "copies", "place", "votes", "overlap", "bit_error")


def groups(table: DataFrame, is_query: Column, key: str, audio: Column) -> DataFrame:
    """One row for each row of `table`: (id, class_id, class_size, links, recording_id, place, votes, overlap, bit_error).

    `class_id` is the least id of the recordings that aligned pairs hold together, a lone recording's its own; `class_size`
    counts their rows. The rest is null for rows that are no queries: `links` counts the other rows that the query aligns
    with, and the last columns are its best alignment (least bit error, then longest overlap, then least recording).
    """
    found = _Aligned(table, is_query, key, audio)
    labels = components(found.pairs.select(F.col("q").alias("a"), F.col("r").alias("b")))
    named = found.classes.select("same", "recording_id", "n").join(labels.withColumnRenamed("node", "same"), "same", "left").withColumn("label", F.coalesce("label", "same"))
    named = cut(named)
    whole = named.groupBy("label").agg(F.min("recording_id").alias("class_id"), F.sum("n").alias("class_size"))
    member = named.join(whole, "label").select("same", "class_id", "class_size")
    order = F.struct("bit_error", (-F.col("overlap")).alias("less"), "recording_id", "place", "votes", "overlap")
    best = found.alignments().groupBy("same").agg(F.sum("copies").alias("links"), F.min(order).alias("best"))
    asked = F.coalesce(is_query, F.lit(False)) & F.col("id").isNotNull() & F.col("same").isNotNull()
    rows = found.prints.select("id", "same", asked.alias("asks")).join(member, "same", "left").join(best, "same", "left")
    only = lambda c: F.when(F.col("asks"), c)
    return rows.select(
        "id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), only(F.coalesce("links", F.lit(0).cast("long"))).alias("links"),
        *[only(F.col(f"best.{c}")).alias(c) for c in ("recording_id", "place", "votes", "overlap", "bit_error")],
    )
