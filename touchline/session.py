"""Session helpers: checkpoint / scratch folder resolution."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (one machine) without the setting gets a folder of
    our own, recorded on the session; on a cluster the setting is required.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None) or _context_dir(spark)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="touchline-ckpt-")
        _set_context_dir(spark, root)
        root = _context_dir(spark) or root
    return root


def _context_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # a remote (Connect) session has no local context
        return None


def _set_context_dir(spark: SparkSession, root: str) -> None:
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # Connect: the server's spark.checkpoint.dir applies
        pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return its folder."""
    root = checkpoint_root(spark)
    if not _context_dir(spark):
        _set_context_dir(spark, root)
    return root


#: Folders written by this program, with what removes them.
_SCRATCH: dict[str, object] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables.

    :func:`drop_path` removes it; what is left goes when the program ends, since a result that reads it may be
    used until then.
    """
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    path = f"{root}{sep}touchline/{name}-{uuid.uuid4().hex[:12]}"
    remove_at_exit(spark, path)
    return path


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder when the program ends (a killed program leaves it to the cluster's own cleaning)."""
    if not _SCRATCH:
        atexit.register(drop_scratch)
    with contextlib.suppress(Exception):  # a remote (Connect) session has no file system of its own
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        _SCRATCH[path] = (where, where.getFileSystem(spark._jsc.hadoopConfiguration()))


def drop_scratch() -> None:
    """Remove every scratch folder of this program."""
    while _SCRATCH:
        _, (where, system) = _SCRATCH.popitem()
        with contextlib.suppress(Exception):  # the JVM may be gone by now
            system.delete(where, True)


@contextlib.contextmanager
def recorded_scratch():
    """The list of the scratch folders that are made inside the block (known when it ends)."""
    before, made = set(_SCRATCH), []
    try:
        yield made
    finally:
        made += [p for p in _SCRATCH if p not in before]


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a written folder through Spark's own file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _SCRATCH.pop(path, None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: short lineage, known size, plain shuffles in later joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "touchline") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        # Python call-site capture for error messages: one JVM round trip per
        # column expression while a plan is built; off for batch runs.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TOUCHLINE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_ratio: float = 1.0,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on ``total_cores`` task slots.

    ``shuffle_ratio`` is the shuffled bytes per input byte of the largest
    stage (the per-part aggregation of ``lineitem`` shuffles about its own
    size, since part keys are spread over all files).  Shuffle partitions
    are sized so each holds about ``target_partition_bytes`` before AQE
    coalesces small ones, never fewer than twice the task slots; file
    splits of the same size keep scan tasks within memory; skew-join and
    partition coalescing stay on.
    """
    shuffle_bytes = int(input_bytes * shuffle_ratio)
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
