"""Session settings the operators rely on, and the shared scratch folder."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without call-site records a large expression is built several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot does not compile larger methods; such stages run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Filters reach the index source (`sources.index`), which else knows only the range it is given.
    "spark.sql.python.filterPushdown.enabled": "true",
    # Stream state on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "adgleaner", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="adgleaner-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster names for checkpoints.

    On one machine, as in tests, it may be a local one. On a cluster a local
    folder is not shared, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
