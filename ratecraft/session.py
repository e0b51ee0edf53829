"""Session defaults and the shared work folder.

Nothing here reads environment variables: callers pass a master and
options, and cluster-wide settings (the checkpoint folder in particular)
are read back from the running session.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Defaults that every job in the library relies on: AQE re-plans joins and
# shuffle sizes at runtime, skewed join partitions are split, time is UTC so
# timestamp arithmetic matches SQL oracles, and streaming state lives in
# RocksDB so keyed state can exceed executor heap.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows are handed to Python by bytes, not only by number: long texts must not fill a worker
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # a batch uploads its own changes, not whole files of state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "ratecraft",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the SQL-level defaults on an existing session (e.g. the driver's), and let its Python
    workers import this package from where the driver has it, if it is not installed there."""
    for k, v in DEFAULT_CONF.items():
        spark.conf.set(k, v)
    here, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, here])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is (and
    a cluster without it is refused).  Only a local master with the setting
    unset (local runs, tests) gets a folder of our own, registered so that
    ``DataFrame.checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder on shared storage; "
                             "a machine-local folder would be lost with its executor")
        root = tempfile.mkdtemp(prefix="ratecraft-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint root (made by whatever writes there)."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
