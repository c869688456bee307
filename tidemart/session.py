"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; all of them can be changed on a live session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time instead of being handled by one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... also where the split costs one more shuffle for the aggregate behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A hot day is split when a partitioned table is written (see sources.writers).
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Overwriting a partitioned table replaces the days that occur in the rows, never all days.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # `ds` is text everywhere; without this, folders named ds=2025-01-01 come back as dates.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Sessions of a hot key are merged within a task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

MB = 1 << 20
# Bytes of the largest table read behind one shuffle partition. A stored row of a dozen bytes takes up to a
# kilobyte in the sorts and hash maps of a task that joins and counts, so a partition is far larger in memory.
SHUFFLE_BYTES = 8 * MB

SHUFFLES = "spark.sql.shuffle.partitions"
LEAST_SHUFFLES = "spark.sql.adaptive.coalescePartitions.minPartitionNum"

_local_scratch: str | None = None


def build_session(app_name: str, settings: dict[str, str] | None = None, *,
                  master: str | None = None, hive: bool = False,
                  encoding: str = "UTF-8", log_level: str = "WARN") -> SparkSession:
    """Create (or reuse) a session with the warehouse settings.

    `settings` win over the defaults; `hive` switches catalog support on; `encoding` is the
    driver's text encoding, which only a new driver process takes over.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {**SQL_SETTINGS, "spark.ui.enabled": "false",
                "spark.driver.extraJavaOptions": f"-Dfile.encoding={encoding}"}
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


class WarehouseSession:
    """Context manager: `with WarehouseSession("nightly") as spark: ...`"""

    def __init__(self, app_name: str, settings: dict[str, str] | None = None, **kwargs):
        self._args = (app_name, settings)
        self._kwargs = kwargs
        self.spark: SparkSession | None = None

    def __enter__(self) -> SparkSession:
        self.spark = build_session(*self._args, **self._kwargs)
        return self.spark

    def __exit__(self, *exc) -> None:
        if self.spark is not None:
            self.spark.stop()


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path as of now; 0 when it does not exist."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def fit(spark: SparkSession, path: str) -> None:
    """Raise the session's shuffle partitions to fit a table that is about to be read.

    Partitions of a fixed number would outgrow an executor's memory; adaptive execution merges those
    that turn out small. It goes by the shuffled bytes, which say little about the memory of a task, so
    it may not merge a stage to fewer partitions than fit, those of under a megabyte excepted. Called on
    sessions made by `prepare`, so a query that reads small tables only stays small, whatever ran
    before it.
    """
    wanted = -(-table_bytes(spark, path) // SHUFFLE_BYTES)
    if wanted > int(spark.conf.get(SHUFFLES)):
        spark.conf.set(SHUFFLES, str(wanted))
    # Without this setting as many are kept as the session has cores.
    if wanted > int(spark.conf.get(LEAST_SHUFFLES, None) or spark.sparkContext.defaultParallelism):
        spark.conf.set(LEAST_SHUFFLES, str(wanted))


def prepare(spark: SparkSession) -> SparkSession:
    """A session of its own with the caller's and the warehouse settings; the caller's stays as it is."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **SQL_SETTINGS}.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def scratch_root(spark: SparkSession) -> str:
    """Folder that all executors can reach, for written intermediate tables.

    The cluster names it in `spark.checkpoint.dir`. Only a local session may fall back to a
    folder of this machine.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tidemart-", dir=os.environ.get("TMPDIR"))
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; no two calls share one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
