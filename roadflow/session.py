"""Session helpers: one place for the runtime settings every job relies on.

Nothing here hard-codes parallelism. Shuffle width comes from the session (the cluster sets
``spark.sql.shuffle.partitions``); AQE coalesces small shuffles and splits skewed ones at run time.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the jobs need for right answers (UTC wall clock for date keys and windows) and
# for scale (AQE re-plans joins from real sizes, splits skewed partitions, coalesces tiny ones).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings roadflow's results depend on. Idempotent."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a run over ``input_bytes`` of (compressed) input.

    The initial shuffle width is input / target (so one shuffle partition stays a few hundred MB and
    fits executor memory with room to spill); AQE then coalesces small partitions to the advisory size
    and splits skewed ones. At 100 TB this gives about 400k initial partitions, which AQE coalesces.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        # coalesce to the advisory size rather than to the core count (fewer, fuller tasks on a cluster)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        # runtime broadcast only from measured shuffle sizes
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Apply ``scale_conf`` to the session (runtime SQL settings only)."""
    for key, value in scale_conf(input_bytes).items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roadflow") -> SparkSession:
    """Session for tests and the local bench; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared working folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests, local runs) a fresh folder is
    made and set on the context. On a cluster an unset value is an error.
    Streaming checkpoints, snapshot files and lineage-cutting tables all live below it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is invisible to other executors: never fall back to one on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="roadflow-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        # the context, not the session conf: spark.checkpoint.dir cannot be changed once a session runs
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (one per call; never reused or cleared)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in whatever store the path names."""
    fs, at = _file_system(spark, path)
    return bool(fs.exists(at))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder (none for a folder that does not exist)."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there at all: written beside its place and moved into it."""
    fs, at = _file_system(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{at.getName()}.{uuid.uuid4().hex[:8]}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(beside, at):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readNBytes(fs.getFileStatus(at).getLen())).decode()
    finally:
        stream.close()


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    fs, at = _file_system(spark, path)
    return fs.getContentSummary(at).getLength()
