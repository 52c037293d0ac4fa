"""Session defaults and lineage cutting shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every operator relies on for reproducible results.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}
#: Rows and bytes of a batch between the JVM and Python where the session has Spark's own 10000 rows of any length: whole
#: texts are long, and both sides hold a batch several times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": (None, "4194304")}


def session(app: str = "tallyweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults; on a cluster `master` and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to a session somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """Give executors this package, for Python functions that run there, unless this application has it already, and keep
    what is sent to them at once small."""
    for key, (usual, ours) in BATCHES.items():
        if usual is None or spark.conf.get(key, usual) == usual:
            spark.conf.set(key, ours)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp()
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch the archive as long as the driver runs
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "tallyweave"), "zip", root, "tallyweave"))
        _shipped.add(app)


_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Only where driver and executors are one process
    (master local) may it be unset; on a cluster a local folder would lose tables, so that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return os.path.join(tempfile.gettempdir(), "tallyweave-checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """`df` as a table written to the shared folder: its lineage ends there, so losing an executor never loses it.

    A table rather than checkpoint(): it is compressed and pruned by column, its size is known to the planner, and it
    does not carry the constraints of the plan it came from, which make planning of iterative jobs ever slower. Tables
    are removed when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Tasks of a shuffle as the session sets them: what operators that deal rows by range divide their work into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession) -> str:
    """A new folder's name in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_folder(spark)}/tallyweave-{os.getpid()}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


_written: list[tuple[SparkSession, str]] = []
atexit.register(lambda: _remove())


def _remove() -> None:
    """Delete the written tables; one that cannot be deleted keeps none of the others."""
    while _written:
        spark, path = _written.pop()
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be gone by now
            continue


def clear() -> None:
    """Delete all intermediate tables so far: for long sessions, once results have been written."""
    _remove()
