"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Targets: the mix's size is shared among sources by weight; no target exceeds REPEATS times its source's size, and what
is over goes to the others by weight until none is above (water filling, solved exactly over the sorted sources).

Copies: a document's expected copies are its source's target over the source's size, times its relative weight if a
weight column is given, at most REPEATS. Whole copies are certain. For one more, documents of a source are ranked by
random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in that order until the source's words come
nearest to its target. u comes from a keyed hash of the id, so reruns agree.

Scale: one pass over the texts gives a slim table (id, source, size, u), which is checkpointed. The place where a source's
order is cut is found from a histogram over BUCKETS parts of the order, so that only the one part it falls in is sorted,
whatever the share of the source. Sources themselves are sorted in one task: there is one row for each.

Null text has size 0; null sources are one source that comes last; a row with a null id has the hash of its text, so that
many such rows do not stand or fall together. Rows with equal ids, and null ids with equal texts, have one u: they are
taken or left together, and the cut comes as near to the target as such a tie allows. Very long texts are counted whole.
Empty table: empty result. Sizes of 0 give targets of 0 and no words. Columns of `docs` stay together as one struct until
the end, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.session import cut

SHARE, REPEATS, WEIGHTS, SEED, BUCKETS = 1.5, 2.0, (5, 2, 1), "mix-1", 4096
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Words parted by ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str, text: Column) -> Column:
    """A number between 0 and 1, never either, from 52 bits of a hash of seed and key, or of the text where that is null."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.concat(F.lit("null "), F.md5(F.coalesce(text, F.lit("")))))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, share: float = SHARE, repeats: float = REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) of (source, source_size)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    # one row a source from here on
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", pick.cast("long")).withColumn("most", F.lit(repeats) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(whole.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    filled = ranked.withColumn("n", F.row_number().over(order)).withColumn("level", level)
    settled = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("n", "level"))).over(whole.partitionBy())["level"]
    return filled.withColumn("settled", settled).select("source", "source_size", F.coalesce(F.least("most", F.col("settled") * F.col("weight")), F.col("most")).alias("target"))


class Mix:
    """What decides a row's copies: the checkpointed slim rows and, for each source, its target and where its order is cut."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None, share: float = SHARE, repeats: float = REPEATS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED):
        self.repeats, self.seed, self.weighted = repeats, seed, weight is not None
        w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
        self.slim = cut(docs.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"), uniform(F.col(key), seed, F.col(text)).alias("u"), w.alias("w")))
        sums = self.slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("w") * F.col("size")).alias("weighted"))
        aims = targets(sums.select("source", "source_size"), share, repeats, weights)
        aims = cut(aims.alias("t").join(sums.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source"))).select("t.source", "t.source_size", "target", "weighted"))
        ranked = self._ranked(self.slim, aims)
        need = ranked.groupBy("of").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("certain")).select("of", (F.col("target") - F.col("certain")).alias("need"))
        parts = ranked.where("p > 0").groupBy("of", "part").agg(F.sum("size").alias("words"))
        # at most BUCKETS rows a source
        upto = parts.withColumn("upto", F.sum("words").over(Window.partitionBy("of").orderBy("part")))
        met = upto.alias("a").join(need.alias("b"), F.col("a.of").eqNullSafe(F.col("b.of"))).select("a.of", "part", "need", (F.col("upto") - F.col("words")).alias("before"), "upto")
        border = met.where("before < need and need < upto")
        inside = ranked.where("p > 0").alias("r").join(border.alias("b"), F.col("r.of").eqNullSafe(F.col("b.of")) & (F.col("r.part") == F.col("b.part"))).select("r.of", "r.part", "order", "size", "need", "before")
        by = Window.partitionBy("of").orderBy("order")
        running = inside.withColumn("to", F.col("before") + F.sum("size").over(by)).withColumn("own", F.sum("size").over(Window.partitionBy("of", "order")))
        last = running.groupBy("of", "part").agg(F.max(F.when(2 * F.col("to") - F.col("own") <= 2 * F.col("need"), F.col("order"))).alias("order"))
        full = met.where("upto <= need").groupBy("of").agg(F.max("part").alias("full"))
        ends = full.alias("f").join(last.alias("l"), F.col("f.of").eqNullSafe(F.col("l.of")), "full_outer").select(F.coalesce("f.of", "l.of").alias("of"), F.coalesce("full", F.lit(-1)).alias("full"), F.col("part").alias("border"), F.col("order").alias("last"))
        self.sources = cut(aims.alias("t").join(ends.alias("e"), F.col("t.source").eqNullSafe(F.col("e.of")), "left").select("t.source", "source_size", "target", "weighted", F.coalesce("full", F.lit(-1)).alias("full"), "border", "last"))

    def _ranked(self, rows: DataFrame, aims: DataFrame) -> DataFrame:
        """Rows with whole copies, the inclusion probability of one more, the place in the order and its part."""
        met = rows.join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        expected = F.col("target") / F.col("source_size")
        if self.weighted:
            expected = F.least(F.lit(self.repeats), F.col("target") * F.col("w") / F.col("weighted"))
        met = met.withColumn("expected", F.when(F.col("source_size") > 0, F.coalesce(expected, F.lit(0.0))).otherwise(F.lit(0.0)))
        met = met.withColumn("whole", F.floor("expected").cast("long")).withColumn("p", F.col("expected") - F.col("whole"))
        odds = (F.col("u") / (F.lit(1.0) - F.col("u"))) / (F.col("p") / (F.lit(1.0) - F.col("p")))
        met = met.withColumn("order", F.when(F.col("p") > 0, odds))
        return met.withColumn("part", F.floor(F.col("order") / (F.lit(1.0) + F.col("order")) * F.lit(BUCKETS)).cast("int"))

    def _with_copies(self, rows: DataFrame) -> DataFrame:
        extra = (F.col("p") > 0) & ((F.col("part") <= F.col("full")) | ((F.col("part") == F.col("border")) & (F.col("order") <= F.col("last"))))
        return self._ranked(rows, self.sources).withColumn("copies", F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long"))

    def table(self) -> DataFrame:
        """(id, size, source_size, target, taken) of each row."""
        return self._with_copies(self.slim).select("id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))

    def taken(self, docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
        """The rows of `docs`, each as often as the mix takes it. Without a weight column only."""
        if self.weighted:
            raise ValueError("rows carry no weight here; join table() instead")
        own = docs.columns
        rows = docs.select(F.struct(*own).alias("__row"), F.col(source).cast("string").alias("source"), uniform(F.col(key), self.seed, F.col(text)).alias("u"))
        return self._with_copies(rows).where("copies > 0").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("__row.*")


#: The mix of table documents with the parameters above.
ORACLE = r"""
with slim as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    (('0x' || substr(md5('mix-1|' || coalesce(doc_id::varchar, 'null ' || md5(coalesce(text, '')))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double as u
  from documents),
sums as (select source, sum(size)::bigint as source_size from slim group by source),
weighed as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3)::int + 1] as weight from sums),
ratios as (select *, 2.0::double * source_size as most, 2.0::double * source_size / weight as ratio from weighed),
levels as (select *, row_number() over (order by ratio, source nulls last) as n,
    (1.5::double * sum(source_size) over ()::double - coalesce(sum(most) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0.0::double))
      / (sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following))::double as level
  from ratios),
settled as (select arg_min(level, n) as level from levels where level <= ratio),
aims as (select l.source, l.source_size, coalesce(least(l.most, s.level * l.weight), l.most) as target from levels l cross join settled s),
ranked as (select d.doc_id, d.source, d.size, d.u, a.source_size, a.target,
    case when a.source_size > 0 then a.target / a.source_size else 0.0::double end as expected
  from slim d join aims a on d.source is not distinct from a.source),
chances as (select *, floor(expected)::bigint as whole, expected - floor(expected)::bigint as p from ranked),
ordered as (select *, case when p > 0 then (u / (1.0::double - u)) / (p / (1.0::double - p)) end as odds,
    target - sum(whole * size) over (partition by source)::double as need from chances),
running as (select *, sum(case when p > 0 then size else 0 end) over (partition by source order by odds nulls last)::double as upto,
    sum(size) over (partition by source, odds)::double as own from ordered)
select doc_id, size, source_size, target, (size * (whole + case when p > 0 and 2 * upto - own <= 2 * need then 1 else 0 end))::bigint as taken
from running
"""
