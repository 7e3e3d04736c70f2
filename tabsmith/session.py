"""Session construction and the shared scratch location.

Library functions never build a session themselves; they take DataFrames.
``get_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from measured shuffle
# sizes (a join side is only broadcast once its real size is known to be under
# the threshold), coalesces small partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the checkpointed DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Extra settings for a large cluster: let AQE merge shuffle partitions towards
# ~256 MB each (instead of maximising task count), split a skewed join partition
# once it is 4x the median and over 512 MB, and read input in 256 MB splits. How
# many partitions a shuffle starts with follows from the input (shuffle_partitions).
PARTITION_BYTES = 256 * 1024**2
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def shuffle_partitions_for(input_bytes: int) -> int:
    """As many partitions as hold the input at ``PARTITION_BYTES`` each. AQE
    merges partitions that turn out small but does not split large ones (but
    for skewed joins), so the start must suit a shuffle of the whole input."""
    return max(200, -(-int(input_bytes) // PARTITION_BYTES))


def get_session(
    master: str | None = None,
    app: str = "tabsmith",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    cluster: bool = False,
    input_bytes: int = 2 * 1024**4,
) -> SparkSession:
    """A session with adaptive execution on; ``cluster=True`` adds the
    partition sizing meant for very large inputs (``CLUSTER_CONF``), with
    shuffles sized for ``input_bytes`` (2 TiB unless told). ``shuffle_partitions``
    overrides that number, in both settings that Spark plans with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SCALE_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
        shuffle_partitions = shuffle_partitions or shuffle_partitions_for(input_bytes)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (a test or a
    laptop run) is a local temporary folder made and registered, so
    ``DataFrame.checkpoint()`` and :func:`scratch_path` work there too; a
    cluster session without the setting is an error. Under Spark Connect there is no
    driver-side context; the server's configuration is used as it is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # Spark Connect: checkpointing is configured on the server
        return (configured or "").rstrip("/")
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        # executors on other machines could not read a driver-local folder
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="tabsmith-ckpt-")
    context.setCheckpointDir(local)
    return local


def materialize(df):
    """``df.checkpoint()`` into the shared checkpoint folder: the plan runs
    once, later jobs read the written copy, and a lost executor never re-runs
    the upstream work. For small derived tables read by several branches."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/tabsmith-scratch/{name}-{uuid.uuid4().hex[:12]}"



def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that is no longer read, on whatever file system
    it lies; one that is gone already is no error. Under Spark Connect there is
    no file system at hand, and the folder stays."""
    if not hasattr(spark, "_jvm"):
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
