"""Session settings, and the shared folder for tables a job writes on the way."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(app_name: str = "folioloom", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings the jobs are written for; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: what the cluster names, or a new one on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="folioloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/folioloom-{label}-{uuid.uuid4().hex}"


# Shuffled bytes one task is to get.
BYTES_PER_TASK = 256 * 1024 * 1024
MIN_BYTES_PER_TASK = 256 * 1024
# Shuffle partitions at most; beyond some 8 TB of shuffled bytes tasks get larger instead of more, since blocks grow with the square.
MAX_TASKS = 32_768


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files under the paths that exist."""
    total = 0
    for path in paths:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        if file_system.exists(hadoop_path):
            total += file_system.getContentSummary(hadoop_path).getLength()
    return total


@contextmanager
def task_share(spark: SparkSession, *paths: str, growth: float = 3.0):
    """While it lasts, rebalancing makes tasks of BYTES_PER_TASK, or smaller ones where the
    input would not give every core two of them. For work that weighs more than its bytes."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    even = int(stored_bytes(spark, *paths) * growth / (2 * spark.sparkContext.defaultParallelism))
    spark.conf.set(key, max(MIN_BYTES_PER_TASK, min(BYTES_PER_TASK, even)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def fit_shuffles(spark: SparkSession, *paths: str, growth: float = 3.0) -> int:
    """Set the number of shuffle partitions from the size of the input files, and return it.

    ``growth`` is what a compressed byte on disk comes to in a shuffle. The number is never
    below the cores at hand and never above MAX_TASKS.
    """
    total = stored_bytes(spark, *paths) * growth
    wanted = max(spark.sparkContext.defaultParallelism, min(MAX_TASKS, int(total / BYTES_PER_TASK) + 1))
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return wanted


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """While it lasts, what an execution has shuffled is dropped at its end, not when the driver happens to collect garbage.

    For jobs that write tables one after another. Rows that are asked for again are computed again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of a running session this package, unless they have it by now.

    Not needed where it is installed on the executors or passed with ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="folioloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
