"""Session settings the jobs rely on, and where a run may keep shared files."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
MAX_TASKS = 100_000

# Needed for right results: text timestamps and month() follow the session zone.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# In place of Spark's own defaults: compressed text grows tenfold in the memory of the task that reads it, and
# a task that keeps the files of a few verdicts open need not sort, and spill, its rows by verdict first.
DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": (f"{128 * MIB}b", f"{48 * MIB}b"),
    "spark.sql.maxConcurrentOutputFileWriters": ("0", "8"),
}

# Helpful at scale.  Defaults of current Spark, but for splitting hot join partitions sooner.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def pin_session(spark: SparkSession) -> SparkSession:
    """Set what the results depend on; leave every other setting to the cluster, if it has chosen one."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    for key, (default, value) in DEFAULTS.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, value)
    return spark


def sized_for(input_bytes: int, cores: int, most_tasks: int = MAX_TASKS) -> dict[str, str]:
    """Task sizes for a job reading so many bytes.

    About 128 MiB per task, so that a sort fits in memory, until that would take more than
    ``most_tasks`` tasks per stage: map outputs are tracked per pair of map and reduce task, so
    from there on the tasks grow instead and their sorts spill.  AQE merges partitions that
    come out small but splits none but hot ones, so the number has to suffice for the
    largest shuffle, which is the input itself.
    """
    target = max(128 * MIB, -(-input_bytes // most_tasks))
    return {
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-input_bytes // target))),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target // 2),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files below some paths or path patterns."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    total = 0
    for path in map(hadoop.Path, paths):
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.globStatus(path) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def planned_bytes(df: DataFrame) -> int:
    """What Spark takes for the size of a frame before it runs: for a plain scan that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_bytes(spark: SparkSession) -> int:
    """Up to which planned size Spark broadcasts one side of a join; negative if it never does."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def size_session(spark: SparkSession, *paths: str) -> dict[str, str]:
    """Set the task sizes of the session for a job over these inputs."""
    settings = sized_for(input_bytes(spark, *paths), spark.sparkContext.defaultParallelism)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings


def build_session(
    app: str = "veriledger", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **REQUIRED, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path, visible to all executors, for a written table or checkpoint.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    session, whose executors are this process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="veriledger-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
