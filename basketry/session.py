"""Spark session helpers.

The library never creates a global session on import. ``get_session`` is for
scripts and tests; production jobs pass their own session in.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the models rely on: ANSI casts, UTC, adaptive execution with
# skew-join splitting and runtime broadcast of sides measured to be small.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that needs an extra shuffle above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "basketry", extra: dict | None = None) -> SparkSession:
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
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. A private folder is
    made only for a local master without that setting; on a cluster a folder
    of one machine would lose data, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="basketry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_table_root(spark: SparkSession) -> str:
    """Folder for materialised tables: a sub-folder of the checkpoint dir."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/tables"


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def input_version(spark: SparkSession, paths) -> tuple:
    """What changes when a table is written anew: path, bytes, files and
    modification time of each (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        size = fs.getContentSummary(path)
        out.append((p, size.getLength(), size.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def partition_settings(total_input_bytes: int, target_partition_bytes: int = 256 << 20,
                       max_partitions: int | None = None) -> dict:
    """Shuffle and scan sizing for a job reading ``total_input_bytes``.

    Shuffle partitions are sized so that an initial partition holds about
    ``target_partition_bytes`` of input (joins and the line-level Expand can
    multiply it a few times, which still fits an executor's execution memory
    and spills otherwise); AQE then coalesces small partitions to the same
    advisory size and splits a partition of a join that exceeds 4x the median
    (and 1 GB). Scan splits use the same target, so one task reads about one
    partition's worth of parquet. ``max_partitions`` is the caller's limit, if
    any."""
    n = max(200, -(-total_input_bytes // target_partition_bytes))
    if max_partitions is not None:
        n = min(n, max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def size_session(spark: SparkSession, paths, target_partition_bytes: int = 256 << 20) -> dict:
    """Apply :func:`partition_settings` for the given inputs to the session
    (runtime SQL settings only)."""
    conf = partition_settings(input_bytes(spark, paths), target_partition_bytes)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
