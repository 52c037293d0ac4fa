import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.mapKeyDedupPolicy", "LAST_WIN").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyweave-"))
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
