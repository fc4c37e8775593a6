"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins/partition counts at run
# time, skew-join splitting is on, and the session clock is UTC so calendar
# parts derived from timestamps do not depend on the machine.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Local sessions (tests, benchmarks) only.
LOCAL_CONF = {"spark.ui.enabled": "false"}


# Extra defaults for cluster runs (not applied to local sessions): many
# shuffle partitions that AQE coalesces towards the advisory size, larger
# scan splits, and skew splitting for partitions far above the median.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def session_settings(
    master: str | None, shuffle_partitions: int | None = None, conf: dict[str, str] | None = None
) -> dict[str, str]:
    """The configuration ``build_session`` applies: library defaults, the
    cluster defaults unless the master is local, then explicit values."""
    local = master is not None and master.startswith("local")
    settings = {**DEFAULT_CONF, **(LOCAL_CONF if local else CLUSTER_CONF), **(conf or {})}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return settings


def build_session(
    master: str | None = None,
    app_name: str = "zonepulse",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control of
    it on a cluster; unless the master is local, ``CLUSTER_CONF`` is added
    (many shuffle partitions for AQE to coalesce, larger scan splits, skew
    splitting). Explicit ``conf`` entries win over both default sets.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in session_settings(master, shuffle_partitions, conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders of the innermost ``passing_copies`` of this thread, if any.
_passing: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:  # Spark Connect sessions expose no SparkContext
        master = spark.conf.get("spark.master", "") or ""
    # local-cluster runs executors in processes (and folders) of their own
    return master.startswith("local") and not master.startswith("local-cluster")


def _shares_disk(spark: SparkSession) -> bool:
    """A ``local-cluster`` master runs its executors on the driver's machine;
    ``spark.zonepulse.sharedFileBase`` says that a ``file:`` folder is a mount
    that all machines share."""
    on_one = spark.sparkContext.master.startswith("local-cluster")
    return on_one or spark.conf.get("spark.zonepulse.sharedFileBase", "false") == "true"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting it only when the session has none.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temporary folder is only used
    for local-mode sessions (tests, benchmarks). The folder also hosts the
    job-owned copies written by ``materialize`` and the stream sinks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, configuration only
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/ABFS) so lineage cuts survive executor loss"
            )
        configured = tempfile.mkdtemp(prefix="zonepulse-ckpt-")
    if configured.startswith("file:") and not _is_local(spark) and not _shares_disk(spark):
        raise RuntimeError(f"spark.checkpoint.dir is {configured}, a folder of each machine; point it at shared storage")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for job-owned outputs
    (stored copies, stream sinks, stream checkpoints).

    The folder is made through Spark's own file system layer, so a path
    without a scheme means the cluster's default file system, never the
    driver's disk, and it is removed when the driver ends, or at the end of
    ``passing_copies``.
    """
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    found = _hadoop(spark, target)
    if found is None:  # the writer makes the folder
        return target
    fs, path = found
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    target = fs.makeQualified(path).toString()
    if (mine := _passing.get()) is not None:
        mine.append(target)
    return target


def _hadoop(spark: SparkSession, target: str):
    """(file system, path) of a folder; None in Spark Connect sessions."""
    try:
        sc = spark.sparkContext
    except Exception:
        return None
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path


def remove_copy(spark: SparkSession, target: str) -> None:
    """Delete a folder of ``scratch_dir`` before the driver ends; one that is
    gone already is left at that."""
    if (found := _hadoop(spark, target)) is not None:
        fs, path = found
        fs.delete(path, True)
        fs.cancelDeleteOnExit(path)


@contextlib.contextmanager
def passing_copies(spark: SparkSession) -> Iterator[None]:
    """Folders that this thread makes inside are deleted at the end, also after
    an error. It goes around a step whose outcome is written to a folder made
    before: frames of the step can't be read any more after it."""
    mine: list[str] = []
    token = _passing.set(mine)
    try:
        yield
    finally:
        _passing.reset(token)
        for target in mine:
            remove_copy(spark, target)


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet to a fresh folder under the
    shared checkpoint folder and reading it back.

    One job computes ``df`` once (``DataFrame.checkpoint`` computes an
    uncached plan twice: once for its count, once to write the files), the
    copy is columnar with statistics, and a lost executor recomputes only
    from the stored copy.
    """
    target = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target)
