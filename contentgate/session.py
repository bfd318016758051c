"""Session settings the engine relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings only: anything about the cluster itself stays with its owner.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # session windows are merged inside a task before they are shuffled
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # a JSON object with a repeated key keeps the last value instead of failing to parse
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Custom stateful operators need a state store with column families.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession, streaming: bool = False) -> SparkSession:
    for key, value in {**RUNTIME_CONF, **(STATE_STORE_CONF if streaming else {})}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="contentgate-")


def shared_dir(spark: SparkSession) -> str:
    """A fresh sub-folder of the checkpoint folder the cluster names.

    Only where none is configured and everything runs in this one process (a laptop) is a
    local folder created; on a cluster executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/contentgate-{uuid.uuid4().hex}"
