"""SparkSession construction and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the library assumes. Timestamps are compared with a fixed split
# instant, so the session time zone is pinned; AQE re-plans joins and coalesces shuffle
# partitions at run time and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keyed streaming state (one row per user) lives in RocksDB, off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cadenza",
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests, benchmarks and the smoke entry point."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (ALS, materialised stages).

    The cluster names it in ``spark.checkpoint.dir``; that setting always wins. Only a
    local-mode session without it (tests, benchmarks) gets a fresh folder under the
    system temp directory. On a cluster a machine-local folder would be lost with the
    executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) before running")
    path = tempfile.mkdtemp(prefix="cadenza-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The pandas functions of the library reference its modules, so executors must be able
    to import them; this is what ``--py-files`` does at submit time. The package is zipped
    on the driver and distributed with ``SparkContext.addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="cadenza-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as zf:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scale_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20,
               max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a given expected shuffle volume (largest stage) and cluster size.

    Shuffle partitions are sized so one partition is about ``target_partition_bytes``
    (fits an executor core's memory share with room for sort buffers), never fewer than
    two waves of tasks; AQE then coalesces small partitions and splits skewed ones at
    run time. Scan splits stay at ``max_split_bytes``. Example: 100 TB scanned with ~20 TB
    of shuffle on 8,000 cores gives 163,840 shuffle partitions of ~128 MB.
    """
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total length of the files below ``paths``, by whatever file system each names."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        total += where.getFileSystem(conf).getContentSummary(where).getLength()
    return total


def job_session(app: str, inputs: list[str], shuffle_per_input_byte: float = 1.0) -> SparkSession:
    """The session of a job: the library's settings, and partitions sized by the job's inputs.

    ``DEFAULT_CONF`` goes into a new session; in one that is already there the settings that
    can still change are set. The largest shuffle is taken as ``shuffle_per_input_byte`` of the
    inputs' size (Parquet against shuffle rows; joins of this library carry a few columns).
    """
    builder = SparkSession.builder.appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sized = scale_conf(int(input_bytes(spark, inputs) * shuffle_per_input_byte), spark.sparkContext.defaultParallelism)
    for key, value in {**DEFAULT_CONF, **sized}.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark
