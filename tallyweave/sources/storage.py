"""Folders in any file system that Spark reads: what stands in them, and versions that count once they are complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    fs, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions under `root`, ascending. A version counts from when Spark's commit has marked it, so
    one that a crash left half written is none."""
    found = [n for n in names(spark, root) if n.startswith("version-") and n[8:].isdigit()]
    return sorted(int(n[8:]) for n in found if exists(spark, f"{root}/{n}/_SUCCESS"))


def write_version(df: DataFrame, root: str, version: int, fmt: str = "parquet", keep: int = 0) -> str:
    """One more version, over what a failed attempt may have left of it; with `keep` older ones beyond that number go."""
    path = f"{root}/version-{version}"
    df.write.mode("overwrite").format(fmt).save(path)
    if keep:
        for old in versions(df.sparkSession, root)[:-keep]:
            remove(df.sparkSession, f"{root}/version-{old}")
    return path
