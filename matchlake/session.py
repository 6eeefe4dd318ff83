"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")

# AQE sizes shuffles, turns joins with a small measured side into broadcasts and
# splits skewed partitions. The event tables are wider than the 100 columns up
# to which Spark generates code and reads Parquet in batches by default. A plan
# whose generated loop is longer than 2500 bytes falls back to many small methods:
# the JIT optimises those at once, a long loop only after millions of rows, or never.
# A shuffle starts with many small partitions, of which AQE joins those that are too small: a fixed number of them
# grows with the input until the wide rows of one no longer fit a task and are spilled. Files are packed with zstd.
TUNING = {
    "spark.sql.codegen.maxFields": "500",
    "spark.sql.codegen.hugeMethodLimit": "2500",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "800",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
# naive source times are compared as UTC
SETTINGS = {"spark.sql.session.timeZone": "UTC", **TUNING}


def tune(spark: SparkSession) -> None:
    """Apply the performance settings to a session built elsewhere."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)


def build_session(app: str = "matchlake", **settings: str) -> SparkSession:
    """Session with the settings above; keyword settings (dots as ``__``) win."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def together(spark: SparkSession, *jobs: Callable[[], Result]) -> list[Result]:
    """Results of independent jobs that run at the same time: while one is planned or waits for its last tasks, the others use the cores.

    All have ended when this returns or raises the error of the first job that failed.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder does if driver and executors are one process; a cluster needs the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="matchlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/matchlake/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder below the scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
