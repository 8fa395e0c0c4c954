"""Runtime settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Skewed sort-merge joins are split even where the split costs one more shuffle:
# one order may own a third of all fills, and the per-order aggregate above the
# join would otherwise pin that order to a single task.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# De-duplication state stays off-heap and is checkpointed incrementally. Its rows are not counted: a
# count takes a lookup before each write. All stores of an executor share one bound, beyond which they write to disk;
# else each keeps up to 64 MB of rows in memory, which is beyond the heap, however many stores there are.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def tune(spark: SparkSession, streaming: bool = False) -> SparkSession:
    settings = {**RUNTIME, **STREAMING} if streaming else RUNTIME
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint directory, or without one under the
    warehouse, which all executors reach too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
