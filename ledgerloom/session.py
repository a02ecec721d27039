"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """Local session used by tests and the bench (never on a cluster).

    AQE stays on so shuffle partitions coalesce, skewed join partitions split
    and small sides are broadcast from runtime sizes.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(map=LAUNCH_CONF)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, local_fallback=True)
    return spark


MB = 1 << 20


def cluster_conf(
    shuffle_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 * MB,
    broadcast_bytes: int = 64 * MB,
) -> dict[str, str]:
    """Runtime SQL settings for a large cluster, sized from the expected shuffle volume.

    Every key can be applied to a live session with ``spark.conf.set``;
    launch-time settings are in :data:`LAUNCH_CONF`.

    Shuffle partitions start at ``shuffle_bytes / target_partition_bytes`` (at
    least two waves of tasks) so that each reduce task fits in executor memory
    without heavy spilling; AQE then coalesces small partitions and splits
    skewed ones at runtime.  File splits use the same target.  The broadcast
    threshold is a size check on measured statistics, so only sides proven
    smaller than ``broadcast_bytes`` are broadcast.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(2 * slots, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.session.timeZone": "UTC",
    }


# Core settings read only when the SparkContext starts (spark-submit --conf or the
# builder of a new session), unlike the runtime SQL settings of cluster_conf().
LAUNCH_CONF = {
    # checkpoint files of unreferenced RDDs are deleted by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def ensure_checkpoint_dir(spark: SparkSession, local_fallback: bool = False) -> str:
    """Return the checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a fresh folder under /tmp.  On
    a cluster an unset folder is an error, since no default is known to be shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not (local_fallback or sc.master.startswith("local")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="ledgerloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for a table that an operator writes."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the folders handed out by :func:`scratch_path`; frames that read them end with them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        n += path.getFileSystem(conf).delete(path, True)
    return n


RELEASE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as each job ends, not when the driver happens to collect garbage.

    For a row of jobs that each store what they make.  The setting is the
    session's, so it also holds for its other threads meanwhile; a frame that is evaluated again shuffles again.
    """
    before = spark.conf.get(RELEASE_CONF, None)
    spark.conf.set(RELEASE_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_CONF)
        else:
            spark.conf.set(RELEASE_CONF, before)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder, as Parquet, and return the stored copy.

    Unlike ``Dataset.checkpoint``, which evaluates its input twice (a count,
    then the write), this runs it once and stores it once, compressed (by zstd,
    which halves the hex digests that snappy leaves as they are), with
    statistics that the planner can use.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
