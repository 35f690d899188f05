"""Session defaults and the shared scratch area.

Everything that has to be written between stages (CSV landing files, bronze tables, checkpoints,
lineage cuts) goes below the folder the cluster names in ``spark.checkpoint.dir``. A machine-local
temporary folder is used only when that setting is absent, which is the case in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partition columns such as ReceivedMonth='01' stay strings on read
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stratum", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
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
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query are deleted when the query ends, not when the driver's garbage
    collector finds them: a job of many queries then holds those of one. A frame that is run a second time is
    shuffled anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only if the session has none (tests)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root for one run of one job."""
    path = f"{checkpoint_root(spark)}/stratum/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path
