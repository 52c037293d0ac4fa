"""Exact token-length histogram: every context limit's totals from one aggregation.

Documents are encoded whole and counted by encoded length. Suffix sums over the lengths then say, for each length that
occurs and taken as a context limit, how many documents reach it, the tokens they hold, and the tokens left when all
documents are cut at the limit. Between two lengths that occur nothing changes but the truncated total, which grows by
`docs_from` of the next length for each token of the limit; so the table answers every limit.

Scale: the histogram has a row for each different length. Sums run within blocks of BLOCK lengths and over the blocks'
totals, so that no task gets all lengths.

Null and empty texts have length 0. Very long texts are encoded whole. Repeated rows count each time, equal lengths are
one row. An empty table has an empty histogram. Only the text is read: other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm import bpe
from tallyweave.session import cut

BLOCK = 1024


def histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(n_tokens, docs) of the whole table."""
    return bpe.encode(docs, path, [], text, ("n_tokens",)).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(counted: DataFrame) -> DataFrame:
    """(n_tokens, docs, docs_from, tokens_from, truncated_total, share_upto) of a histogram (n_tokens, docs)."""
    rows = cut(counted.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("docs")))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row for each block of lengths
    totals = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"), F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all"))
    own = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    met = rows.join(totals, "block").withColumn("docs_from", F.col("d_after") + F.sum("docs").over(own)).withColumn("tokens_from", F.col("t_after") + F.sum("tokens").over(own))
    return met.select(
        "n_tokens",
        "docs",
        "docs_from",
        "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
        ((F.col("d_all") - F.col("docs_from") + F.col("docs")) / F.col("d_all")).alias("share_upto"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, tokens_cut) for a caller's list of limits, from suffix_sums(): documents longer than the
    limit, and the tokens that cutting them takes away. One pass with a pair of sums for each limit, no join."""
    asked = sorted(set(map(int, limits)))
    if not asked:
        return sums.sparkSession.createDataFrame([], "context_limit long, docs_over long, tokens_cut long")
    over = lambda x: F.greatest(F.col("n_tokens") - F.lit(x), F.lit(0)).cast("long")
    found = sums.agg(*[F.struct(F.lit(x).cast("long").alias("context_limit"), F.coalesce(F.sum(F.when(F.col("n_tokens") > x, F.col("docs"))), F.lit(0)).cast("long").alias("docs_over"), F.coalesce(F.sum(F.col("docs") * over(x)), F.lit(0)).cast("long").alias("tokens_cut")).alias(f"at{k}") for k, x in enumerate(asked)])
    return found.select(F.explode(F.array(*[F.col(f"at{k}") for k in range(len(asked))])).alias("a")).select("a.*")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length up to which at least that share of the documents reaches; null without documents."""
    found = sums.agg(*[F.min(F.when(F.col("share_upto") >= x, F.col("n_tokens"))).alias(f"at{k}") for k, x in enumerate(shares)])
    return found.select(F.explode(F.array(*[F.struct(F.lit(float(x)).alias("share"), F.col(f"at{k}").alias("n_tokens")) for k, x in enumerate(shares)])).alias("a")).select("a.*")
