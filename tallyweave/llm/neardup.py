"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF word shingles.

1. Document frequencies of all five-word shingles are counted over the whole corpus in a sketch (several rows of counters, a
   shingle's count is the least of its counters after taking off what others add on average), sized by the number of texts
   up to a bound. Rare shingles come out as 1 or little more, frequent ones close to the truth.
2. A shingle weighs (1 + ln tf) * idf with idf = 1 + IDF_SHARE * ln(N / df) / ln N, so that between 1 and 1 + IDF_SHARE:
   a rare shingle counts that much more than one which every text has. The share is bounded because near copies must stay
   near: inside a group of copies with a third of all rows the common shingles are the frequent ones and the changed ones
   rare, and an idf without bound would make any change weigh more than all that is common.
3. Each text gets HASHES samples by ICWS (more for low thresholds). The random numbers of a (shingle, hash number) pair are taken from a table,
   and ln a of each (table entry, weight level) is computed beforehand, so that a sample costs one lookup. Weights
   count in steps of 1/64 of their logarithm to base e, for sampling and verifying alike.
4. Several samples (four at 0.8) make a band key. Texts that share a band key and are not yet of one class are candidates; equal texts
   were merged before. FIRSTS times every text is held against the first of one of its buckets, then against those of
   all buckets where it is still of another class; STARS times one member outside the first's class is held against its
   bucket, and at last all that are left out against all members of other classes. Buckets of one class are done and
   leave. Not verified are only pairs for which total weights and bitmaps of shingles prove a similarity below the
   threshold: a bit that only one text has stands for at least one shingle that only this text has, and a shingle weighs
   1 or more. Banding is thus the one step that can miss a pair; bands and rows follow from the threshold (`banding`).
5. Pairs are verified by exact weighted Jaccard similarity. Classes are the connected components of verified pairs.

No group is collected in one task: equal texts are merged within tasks before they are shuffled, and buckets and classes
meet by sort-merge joins of written tables, which adaptive execution splits when skewed.

Null text: a class of its own. Text without any word: classed by equal text alone. Fewer than five words: one shingle.
Equal texts are one class, even if doc_ids repeat; rows of a repeated doc_id are classed by their own text. A null
doc_id is kept; the class id is the least id in the class, null if it has none. Very long texts are read whole. Ties in
sampling go to the least shingle. An empty table gives an empty result. Only key and text are read: others cannot clash.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.textkernel import Words, chunked, mix, shingles
from tallyweave.session import cut

SHINGLE_WORDS = 5
THRESHOLD = 0.8
HASHES = 56
#: Most pairs at the threshold that may share no band, as a share.
MISSED = 1e-3
IDF_SHARE = 0.25
#: Rounds of each text against the first of one bucket, and of one outsider against its bucket, before all that are left.
FIRSTS, STARS = 2, 2
#: Links that one task may finish: some 30 MB.
FEW_LINKS = 200_000
#: Texts with more than this part of all rows as copies are merged before the shuffle: fewer than HOT of them, some 40 kB.
HOT = 1000
#: Longs of a text's bitmap of shingles.
BITMAP = 16
#: Rows of the sketch, the least and most bits of a counter's number, counters a text, and counters in a block.
SKETCH_ROWS, SKETCH_BITS, COUNTERS, BLOCK = 2, (18, 20), 2, 8192
ENTRY_BITS, STEPS_PER_E, LEVELS = 13, 64, 192


def doc_frequencies(docs: DataFrame, text: str, size: int) -> tuple[np.ndarray, int]:
    """The sketch of document frequencies (SKETCH_ROWS rows of counters) and the number of texts with words."""
    bits = min(max((COUNTERS * docs.count()).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((SKETCH_ROWS, 1 << bits), dtype=np.uint32)  # a task has fewer texts than that
        seen = 0
        for batch in batches:
            for _, texts in chunked(batch.column(0).to_pylist()):
                words = Words(texts)
                found = []
                for a, b in zip(words.firsts[:-1], words.firsts[1:]):
                    if b > a:
                        found.append(np.unique(shingles(words.hashes[a:b], size)))
                        seen += 1
                if found:
                    every = np.concatenate(found)
                    for r in range(SKETCH_ROWS):
                        np.add.at(table[r], _counter(every, r, bits), np.uint32(1))
        if seen:
            # a counter takes as few bytes as the block's greatest needs, and blocks of nothing stay away
            flat = [(k, _narrow(row)) for k, row in enumerate(table.reshape(-1, BLOCK)) if row.any()]
            yield pa.RecordBatch.from_pydict({"block": pa.array([k for k, _ in flat] + [-1], pa.int32()), "width": pa.array([x.itemsize for _, x in flat] + [8], pa.int32()), "counts": pa.array([x.tobytes() for _, x in flat] + [np.uint64(seen).tobytes()], pa.binary())})

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), dtype=f"u{w.as_py()}").astype(np.uint64) for w, x in zip(table.column("width"), table.column("counts")))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "width": pa.array([8], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "block int, width int, counts binary"
    # summed by block: each task gets some blocks of all tasks before it, the driver a sketch of bounded size
    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, schema)
    sketch = np.zeros((SKETCH_ROWS << bits) // BLOCK * BLOCK, dtype=np.int64).reshape(-1, BLOCK)
    n = 0
    for r in parts.groupBy("block").applyInArrow(add, schema).collect():
        values = np.frombuffer(r["counts"], dtype=np.uint64).astype(np.int64)
        if r["block"] < 0:
            n = int(values[0])
        else:
            sketch[r["block"]] = values
    return sketch.reshape(SKETCH_ROWS, -1), n


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if counts.max() <= np.iinfo(kind).max))


def _counter(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((h >> np.uint64(row * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)


class Weigher:
    """Weight levels of a text's shingles; a level is the weight's logarithm in steps, the same everywhere."""

    def __init__(self, sketch: np.ndarray, n: int, size: int, idf_share: float = IDF_SHARE):
        self.size, self.n, self.share = size, max(n, 2), idf_share
        self.bits = sketch.shape[1].bit_length() - 1
        self.counts = np.maximum(sketch - sketch.mean(axis=1, keepdims=True), 1.0).astype(np.float32)

    def levels(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles in ascending order and their weight levels."""
        found, tf = np.unique(shingles(hashes, self.size), return_counts=True)
        df = np.min([self.counts[r][_counter(found, r, self.bits)] for r in range(SKETCH_ROWS)], axis=0) if len(found) else np.ones(0)
        idf = 1 + self.share * np.clip(np.log(self.n / np.minimum(df, self.n)) / math.log(self.n), 0, 1)
        weight = (1 + np.log(tf)) * idf
        return found, np.minimum(np.rint(np.log(weight) * STEPS_PER_E), LEVELS - 1).astype(np.int64)


#: Weight of each level.
LEVEL_WEIGHTS = np.exp(np.arange(LEVELS) / STEPS_PER_E)


def banding(threshold: float) -> tuple[int, int]:
    """(bands, rows): as many rows as HASHES samples allow with MISSED kept; more bands of one row for low thresholds."""
    if not 0 < threshold <= 1:
        raise ValueError("a threshold over 0 and up to 1 is needed")
    for rows in range(HASHES, 0, -1):
        if (1 - threshold**rows) ** (HASHES // rows) <= MISSED:
            return HASHES // rows, rows
    return math.ceil(math.log(MISSED) / math.log1p(-threshold)), 1


@functools.lru_cache(maxsize=4)
def tables(hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln a and t of each (weight level, entry) and the odd multipliers that pick an entry for each hash number."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    n = 1 << ENTRY_BITS
    r, c, beta = rng.gamma(2.0, 1.0, n), rng.gamma(2.0, 1.0, n), rng.random(n)
    log_s = np.arange(LEVELS)[:, None] / STEPS_PER_E
    t = np.floor(log_s / r + beta)
    log_a = np.log(c) - r * (t - beta) - r
    odd = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return log_a.astype(np.float32).ravel(), t.astype(np.int64).ravel(), odd


def signature(found: np.ndarray, level: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """As many samples, each a hash of the sampled shingle and its t; ties go to the least shingle."""
    log_a, t, odd = tables(hashes)
    base = level << ENTRY_BITS
    out = np.empty(hashes, dtype=np.uint64)
    step = max(1, (1 << 17) // len(found))
    for k in range(0, hashes, step):
        entry = ((found[None, :] * odd[k : k + step, None]) >> np.uint64(64 - ENTRY_BITS)).astype(np.int64) + base[None, :]
        best = log_a[entry].argmin(axis=1)
        out[k : k + step] = mix(found[best] + mix(t[entry[np.arange(len(best)), best]].astype(np.uint64)))
    return out


def bitmap(found: np.ndarray) -> np.ndarray:
    """BITMAP longs with a bit for each shingle; shingles may share one."""
    bits = np.zeros(BITMAP * 64, dtype=np.uint8)
    bits[(found >> np.uint64(20)).astype(np.int64) % len(bits)] = 1
    return np.packbits(bits).view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' (shingles, levels)."""
    wa, wb = LEVEL_WEIGHTS[a[1]], LEVEL_WEIGHTS[b[1]]
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(wa[ia], wb[ib]).sum()
    total = wa.sum() + wb.sum() - both
    return float(both / total) if total else 0.0


def _signed(docs: DataFrame, key: str, text: str, shared, threshold: float) -> DataFrame:
    """(id, same: digest of the text, bands, total weight) of each row."""
    n_bands, n_rows = banding(threshold)
    source = docs.select(F.col(key).cast("long").alias("id"), F.md5(F.col(text)).alias("same"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = shared.value
        for batch in batches:
            for at, texts in chunked(batch.column(2).to_pylist()):
                words = Words(texts)
                bands, totals = [], []
                for a, b in zip(words.firsts[:-1], words.firsts[1:]):
                    if b == a:
                        bands.append(None)
                        totals.append(None)
                        continue
                    found, level = weigher.levels(words.hashes[a:b])
                    totals.append(LEVEL_WEIGHTS[level].sum())
                    samples = signature(found, level, n_bands * n_rows)
                    keys = np.zeros(n_bands, dtype=np.uint64)
                    for r in range(n_rows):
                        keys = mix(keys + samples[r::n_rows])
                    bands.append(keys.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), pa.array(bands, pa.list_(pa.int64())), pa.array(totals, pa.float64())], names=["id", "same", "bands", "total"])

    return source.mapInArrow(run, "id long, same string, bands array<long>, total double")


def _verified(pairs: DataFrame, weighed: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of texts' digests whose weighted Jaccard similarity reaches the threshold."""
    side = lambda x: weighed.select(F.col("same").alias(x), F.col("found").alias(f"found_{x}"), F.col("level").alias(f"level_{x}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "found_a", "level_a", "found_b", "level_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                fa, la, fb, lb = (batch.column(k)[i].as_buffer() for k in (2, 3, 4, 5))
                good.append(similarity((np.frombuffer(fa, np.uint64), np.frombuffer(la, np.uint8)), (np.frombuffer(fb, np.uint64), np.frombuffer(lb, np.uint8))) >= threshold)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a string, b string")


def _weighed(docs: DataFrame, text: str, wanted: DataFrame, hot: DataFrame, shared) -> DataFrame:
    """(same, found, level, bits): distinct shingles, their weight levels and bitmap of each text in `wanted`.

    Texts in `hot` have so many copies that these are merged within tasks before they are shuffled; all others are few, and
    merged after the shuffle, which needs no sorting of whole texts before it.
    """
    every = docs.select(F.md5(F.col(text)).alias("same"), F.col(text).alias("text"))
    rows = every.join(wanted, "same", "left_semi").dropDuplicates(["same"])
    if not hot.isEmpty():
        rows = every.join(F.broadcast(hot), "same", "left_anti").join(wanted, "same", "left_semi").dropDuplicates(["same"])
        merged = every.join(F.broadcast(hot), "same", "left_semi").groupBy("same").agg(F.first("text").alias("text"))
        rows = rows.union(merged.join(wanted, "same", "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunked(batch.column(1).to_pylist()):
                words = Words(texts)
                each = [shared.value.levels(words.hashes[a:b]) for a, b in zip(words.firsts[:-1], words.firsts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array([f.tobytes() for f, _ in each], pa.binary()), pa.array([x.astype(np.uint8).tobytes() for _, x in each], pa.binary()), pa.array([bitmap(f) for f, _ in each], pa.list_(pa.int64()))], names=["same", "found", "level", "bits"])

    return rows.mapInArrow(run, "same string, found binary, level binary, bits array<long>")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in `links` (a, b): the least node of each connected component.

    Each round hooks every node to its least smaller neighbour, shortens the resulting trees to stars and contracts the
    links to the stars' centres, which leaves at most half of the nodes. Links that have come down to FEW_LINKS are
    finished by one task, which spares many short jobs and gives the same labels.
    """
    links = cut(links.select("a", "b").where("a <> b").distinct())
    if links.count() <= FEW_LINKS:
        return cut(links.coalesce(1).mapInArrow(_united, "node string, label string"))
    labels = cut(links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct().select("node", F.col("node").alias("label")))
    while not links.isEmpty():
        stars = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).groupBy("node").agg(F.min("to").alias("to"))
        stars = cut(stars.withColumn("moved", F.lit(True)))
        while not stars.where("moved").isEmpty():
            up = stars.select(F.col("node").alias("to"), F.col("to").alias("further"))
            stars = cut(stars.join(up, "to", "left").select("node", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
        labels = cut(_renamed(labels, "label", stars))
        links = cut(_renamed(_renamed(links, "a", stars), "b", stars).where("a <> b").distinct())
        if links.count() <= FEW_LINKS:
            rest = links.coalesce(1).mapInArrow(_united, "node string, label string")
            return cut(_renamed(labels, "label", rest.withColumnRenamed("label", "to")))
    return labels


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels of a bounded number of links, by union and find."""
    above: dict[str, str] = {}

    def top(x: str) -> str:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array([top(x) for x in nodes], pa.string())], names=["node", "label"])


def _renamed(rows: DataFrame, column: str, stars: DataFrame) -> DataFrame:
    names = stars.select(F.col("node").alias(column), F.col("to").alias("__to"))
    return rows.join(names, column, "left").withColumn(column, F.coalesce("__to", column)).select(*rows.columns)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, threshold: float = THRESHOLD, idf_share: float = IDF_SHARE) -> DataFrame:
    """(id, class_id, class_size) of each row of `docs`: class_id is the least id of the row's near-duplicate class."""
    spark = docs.sparkSession
    sketch, n = doc_frequencies(docs, text, size)
    shared = spark.sparkContext.broadcast(Weigher(sketch, n, size, idf_share))
    signed = cut(_signed(docs, key, text, shared, threshold))
    merged = cut(signed.where("same is not null and bands is not null").groupBy("same").agg(F.first("bands").alias("bands"), F.first("total").alias("total"), F.count(F.lit(1)).alias("n")))
    # fewer than HOT digests can have more than this share of the rows each
    hot = merged.where(F.col("n") > max(1, n // HOT)).select("same")

    live = cut(_buckets(merged))
    weighed = cut(_weighed(docs, text, live.select("same").distinct(), hot, shared))
    ones = sum((F.bit_count(F.get("bits", F.lit(k))) for k in range(BITMAP)), F.lit(0))
    # spare: weight beyond 1 for each bit
    carried = merged.select("same", "total", F.transform("bands", lambda key, band: F.xxhash64(band, key)).alias("buckets")).join(weighed.select("same", "bits"), "same")
    carried = cut(carried.withColumn("spare", F.col("total") - ones))
    # (same, label) of all texts in buckets
    labels = cut(live.select("same", F.col("same").alias("label")).distinct())
    for turn in range(FIRSTS + STARS + 2):
        live = cut(_unsettled(live, labels))
        if live.isEmpty():
            break
        if turn <= FIRSTS:
            tried = _with_firsts(live, carried, threshold, turn if turn < FIRSTS else None)
        else:
            tried = _left_out(live, carried, threshold, turn if turn <= FIRSTS + STARS else None)
        pairs = cut(tried.distinct())
        if pairs.isEmpty():
            continue
        links = _verified(pairs, weighed, threshold)
        by_label = links.join(labels.select(F.col("same").alias("a"), F.col("label").alias("la")), "a").join(labels.select(F.col("same").alias("b"), F.col("label").alias("lb")), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        labels = cut(_renamed(labels, "label", components(by_label).select("node", F.col("label").alias("to"))))

    named = signed.select("id", "same").join(labels, "same", "left")
    # null text: no digest, so the id itself keeps the rows apart
    named = cut(named.select("id", F.coalesce("label", "same", F.concat(F.lit("null "), F.coalesce(F.col("id").cast("string"), F.lit("")))).alias("label")))
    # written, so that a large class stands in the join as a plain shuffle, which can be split
    sizes = cut(named.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return named.join(sizes, "label").select("id", "class_id", "class_size")


def _buckets(merged: DataFrame) -> DataFrame:
    """(bucket, same) for buckets of at least two different texts."""
    rows = merged.select("same", F.posexplode("bands").alias("band", "key")).select(F.xxhash64("band", "key").alias("bucket"), "same")
    full = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(full, "bucket", "left_semi")


def _unsettled(live: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, same, label, first, main) of buckets with several classes: first is the least member, main its class."""
    placed = live.select("bucket", "same").join(labels, "same")
    several = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("same", "label")).alias("head")).where("low <> high")
    return placed.join(several.select("bucket", F.col("head.same").alias("first"), F.col("head.label").alias("main")), "bucket").select("bucket", "same", "label", "first", "main")


def _near(threshold: float) -> Column:
    """Whether total weights and bitmaps of a and b leave the threshold within reach: no pair that reaches it is left out."""
    both = sum((F.bit_count(F.get("bits_a", F.lit(k)).bitwiseAND(F.get("bits_b", F.lit(k)))) for k in range(BITMAP)), F.lit(0))
    # at most this much weight is common (every term stands once: join conditions are not shared out); 1e-9 is for rounding
    common = (F.least("spare_a", "spare_b") + both) * (1 + 1e-9)
    return (F.least("total_a", "total_b") >= threshold * F.greatest("total_a", "total_b")) & (common * (1 + threshold) >= threshold * (F.col("total_a") + F.col("total_b")))


def _side(carried: DataFrame, x: str, *more: str) -> DataFrame:
    """What is known of a text, under the name of its place in a pair."""
    return carried.select(F.col("same").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("total", "bits", "spare", *more)])


def _with_firsts(live: DataFrame, carried: DataFrame, threshold: float, turn: int | None) -> DataFrame:
    """Each text outside its bucket's main class and the bucket's first; with a turn, of one bucket for each text."""
    outside = live.where("label <> main").select(F.col("first").alias("a"), F.col("same").alias("b"))
    if turn is None:
        outside = outside.distinct()
    else:
        # large buckets tend to have low firsts: they come at the first turn
        order = F.struct("a") if turn == 0 else F.struct(F.xxhash64("a", F.lit(turn)), "a")
        outside = outside.groupBy("b").agg(F.min(order)["a"].alias("a"))
    met = outside.join(_side(carried, "a"), "a").join(_side(carried, "b"), "b")
    return met.where(_near(threshold)).select("a", "b")


def _left_out(live: DataFrame, carried: DataFrame, threshold: float, turn: int | None) -> DataFrame:
    """Candidate pairs of members of one bucket in different classes.

    Members outside the class of the bucket's first start pairs: with a turn one of them, another each turn, otherwise
    all. Total weights and bitmaps are looked at within the join, and of all buckets that a pair shares (none is settled, as
    the pair is of two classes) only the first lets it through, so that a pair comes up once however alike the texts are.
    """
    outside = live.where("label <> main")
    if turn is not None:
        # one bucket of the same outsiders is enough
        one = outside.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("same", F.lit(turn)), "same"))["same"].alias("same"))
        outside = outside.join(one, ["bucket", "same"], "left_semi")
    left = outside.select("bucket", F.col("same").alias("a"), F.col("label").alias("label_a"), "main").join(_side(carried, "a", "buckets"), "a")
    members = live.where("same <> first")
    right = members.select(F.col("bucket").alias("bucket_b"), F.col("same").alias("b"), F.col("label").alias("label_b")).join(_side(carried, "b", "buckets"), "b")
    once = F.lit(True) if turn is not None else ((F.col("a") < F.col("b")) | (F.col("label_b") == F.col("main"))) & (F.get(F.array_intersect("buckets_a", "buckets_b"), F.lit(0)) == F.col("bucket"))
    met = left.join(right, (F.col("bucket") == F.col("bucket_b")) & (F.col("label_a") != F.col("label_b")) & _near(threshold) & once)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
