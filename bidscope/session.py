"""Session helpers.

On a cluster the session already exists and carries the operator's settings;
``tune`` only fills settings that are unset.  ``checkpoint_dir`` reads the
shared folder named by ``spark.checkpoint.dir`` and raises when it is unset:
a folder of this machine would be another folder on every executor.  Tests,
the benchmark and the tools name one when they build their session.  Tables
written there live under a name of this run and are removed when it ends.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that keep plans adaptive at any scale.  Applied only when unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE converts a join to a broadcast only after measuring the built side
    # at runtime; this is the size check behind every non-hinted join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "bidscope", checkpoint: str | None = None) -> SparkSession:
    """Local session for tests/bench.  Clusters pass their own session.
    ``checkpoint`` names the folder for written tables of a local run."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all "
                         "executors share when building the session")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_RUN = uuid.uuid4().hex[:12]
_roots: set[str] = set()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, through Spark's file system layer."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _remove_run(spark: SparkSession, root: str) -> None:
    try:
        remove_path(spark, root)
    except Exception:       # the session has ended: its gateway is gone, nothing is left to ask
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for this run's tables."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/tables/{_RUN}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_remove_run, spark, root)
    return f"{root}/{name}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: For rows of a megabyte: Parquet counts bytes after each, not after a hundred,
#: so neither its writer nor a reader's batch holds all rows of a task.
FAT_ROWS = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1,
            "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}


def stage(df: DataFrame, name: str, **options: int) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used for an intermediate that many branches of one plan read (e.g. the
    contract view behind ten rules): later reads are plain scans with column
    pruning and filter pushdown instead of re-running the joins, and the
    lineage is cut, so a lost executor re-reads files.  ``options`` are the
    writer's."""
    path = scratch_path(df.sparkSession, f"stage/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").options(**options).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.staged_at = path
    return written


#: Shuffles of a written query are removed when it ends: what reads the table needs them no more.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_small(df: DataFrame, name: str, **options: int) -> DataFrame:
    """As ``stage``, for the contract plans: less on disk.  The table is
    smaller, and the shuffles behind it are removed."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        return stage(df, name, **{"compression": "zstd"} | options)
    finally:
        spark.conf.unset(_CLEANED) if before is None else spark.conf.set(_CLEANED, before)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffles that no plan refers to any more, as
    those behind an ``rdd``: it acts when the driver's JVM collects garbage."""
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stage`` returned; nothing may read them later."""
    for table in tables:
        remove_path(table.sparkSession, table.staged_at)
