"""The corpus pipeline: quality, near duplicates, personal data, mixing, tokens. Each stage is (name, function)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import bpe, mixing, neardup, pii, quality, registry
from tallyweave.llm.textkernel import unused
from tallyweave.session import cut, ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of 0.7 or more)."""
    ship(spark)
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused("score", docs.columns)
    return quality.scored(docs, model, docs.columns, score=score).where(F.col(score) >= 0.7).select(*docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: the one with the least id, of equal ids that with the least digest of its text;
    a row without an id only where the whole class has none. Rows without text stay, one for each id they have."""
    # written once, so that a row's key is the same at every reading; texts are moved once more only, by that key
    row = unused("__row", docs.columns)
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    classes = neardup.classes(rows, key=row).select(F.col("id").alias(row), F.col("class_id").alias("__class"))
    slim = cut(rows.select(row, "doc_id", F.md5("text").alias("digest")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", row)
    no_text = F.when(F.col("digest").isNull(), F.col("doc_id"))
    one = F.when(no_text.isNotNull(), F.concat(F.lit("null "), no_text.cast("string"))).otherwise(F.col("__class").cast("string"))
    heads = slim.join(classes, row).groupBy(one.alias("__one")).agg(F.min(order)[row].alias(row))
    return rows.join(heads, row, "left_semi").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the new text."""
    new = pii.replace(docs, registry.surrogate_key(spark), count=None)
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.Mix(docs).taken(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix."""
    return bpe.encode(docs, registry.TOKENIZER, ["doc_id", "lang", "source"], want=("n_tokens", "ids"))


STAGES = [("quality", quality_stage), ("near_duplicates", neardup_stage), ("surrogates", pii_stage), ("mix", mix_stage), ("tokens", token_stage)]

#: Classifier, surrogates and tokens are beyond SQL; tests compare the operators with plain versions, and stage near_duplicates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over table documents. What a stage keeps is checkpointed, so that the next ones read it, not redo it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut(docs)
    return docs
