"""The thin queries of this subpackage: each applies an operator with its production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import audio, bpe, langid, lengths, mixing, neardup, nearest, pii, quality, toxicity
from tallyweave.session import ship

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: Key of the surrogates where the session names none in `tallyweave.surrogate.key`: it is public, for test tables only.
TEST_KEY = "public-test-key"


def surrogate_key(spark: SparkSession) -> str:
    return spark.conf.get("tallyweave.surrogate.key", None) or TEST_KEY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(of: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, class_size of every document."""
    return neardup.classes(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), TOKENIZER, ["doc_id"], want=("n_tokens", "ids_sha256", "decoded_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(_remainder(4) != 2))
    return langid.identify(docs.withColumn("held_out", F.coalesce(_remainder(4) == 2, F.lit(False))), model, ["doc_id", "held_out"])


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with surrogates, and how many were put in."""
    return pii.replace(_table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_table(spark, sf_dir, "documents")).table().withColumnRenamed("id", "doc_id")


def op6_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' bytes as raw 8-bit audio, for want of a table with sound: every hundredth is searched for in all; each
    document with its class, each query with its links and its best alignment."""
    return audio.groups(_table(spark, sf_dir, "documents"), F.col("id") % 100 == 0, "doc_id", F.encode("text", "UTF-8")).withColumnRenamed("id", "doc_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.learn(docs, _table(spark, sf_dir, "labels").where(_remainder(4) != 2))
    rows = quality.scored(docs.withColumn("held_out", F.coalesce(_remainder(4) == 2, F.lit(False))), model, ["doc_id", "held_out"])
    return rows.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.suffix_sums(lengths.histogram(_table(spark, sf_dir, "documents"), TOKENIZER))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels").where(_remainder(5) != 0))
    rows = toxicity.scored(docs.withColumn("held_out", F.coalesce(_remainder(5) == 0, F.lit(False))), model, ["doc_id", "held_out"])
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_bpe, op3_language, op4_surrogates, op5_mix, op6_recordings, op7_quality, op8_token_counts, op9_neighbours, op10_toxicity)}
ORACLES = {"op5_mix": mixing.ORACLE}
