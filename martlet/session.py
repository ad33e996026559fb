"""Session settings every job relies on, and the shared working folder.

Timestamps are staged as UTC wall-clock values, so the session time zone is
pinned to UTC; casts are ANSI (malformed input raises); identifiers resolve
case-insensitively because RAW columns land upper-case; AQE re-plans joins
and splits skewed partitions at runtime.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: An action's shuffle files go when it ends, not when the driver happens to collect garbage; its result is written or read by then.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task's rows, and so its memory, stay the same on larger tables; more tasks take them, and none has to spill.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Partitioned writes keep a few files open per task instead of sorting its rows; further partitions are sorted.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    **SHUFFLES_GO,
}
#: Bytes of a query's tables for which its shuffles get one partition; AQE joins those that turn out small.
PARTITION_BYTES = 8 << 20


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "martlet", extra: dict | None = None) -> SparkSession:
    """A session with the settings above.

    ``master`` and ``shuffle_partitions`` are left to the deployment (``spark-submit``,
    ``spark-defaults.conf``) unless they are given.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession, settings: dict[str, str] = SQL_CONF) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else built."""
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, table_bytes: int) -> None:
    """Let shuffles begin with partitions in proportion to the tables, and no fewer than the deployment sets: sorts and hashes of a
    task then stay as small on larger tables, so they need not spill."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    configure(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(least, -(-table_bytes // PARTITION_BYTES)))})


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job has written and needs no more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def assert_utc(spark: SparkSession) -> None:
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise RuntimeError(f"session time zone must be UTC, not {tz!r}")


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (so a private folder is seen by all)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be shared storage;
    without it this raises. Only a local session (tests) gets a private folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="martlet-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # a core setting some deployments refuse to change at runtime
            pass
    return root.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the checkpoint root for one run of one job."""
    return f"{checkpoint_root(spark)}/martlet/{purpose}/{uuid.uuid4().hex}"


def run_concurrently(actions: dict, workers: int = 4) -> dict:
    """Run independent Spark actions from ``workers`` driver threads; results by name.

    Spark schedules the concurrent jobs on the same executors (use a FAIR pool
    on a shared cluster); each action is an ordinary job with its own retries.
    """
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in actions.items()}
        return {name: f.result() for name, f in futures.items()}
