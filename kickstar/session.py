"""Session helpers.

On a cluster the session is created by the platform; ``configure`` only fills in
settings that are unset, so cluster-wide choices (shuffle partitions, checkpoint
directory, broadcast threshold) win.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings this engine relies on; applied only when the session has no value yet.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Map-side partial aggregation is the skew remedy for group-bys; keep it on.
    "spark.sql.execution.useObjectHashAggregateExec": "true",
    # Rows may hold whole texts: fewer of them at a time between the JVM and Python.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


# Sizes of the pieces that the warehouse's queries work on: a task sorts or hashes what it reads
# and shuffled rows unpack to many times their bytes, so pieces stay well below a task's memory.
PIECES = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes of the input (compressed columns) for each partition that a shuffle begins with.
INPUT_BYTES_A_PARTITION = 2 << 20
_set_here: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    _fill(spark, DEFAULTS)
    checkpoint_dir(spark)
    return spark


def _fill(spark: SparkSession, settings: dict[str, str]) -> None:
    for key, value in settings.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def partitions_for(input_bytes: int, shuffle_partitions: int) -> int:
    return max(shuffle_partitions, -(-input_bytes // INPUT_BYTES_A_PARTITION))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Begin shuffles with partitions in number to the input, which adaptive execution merges to
    its advisory size: with a fixed number, a partition grows with the input until its sort or
    hash table spills. A number that the session was given stays."""
    _fill(spark, PIECES)
    session = spark._jsparkSession.sessionUUID()
    now = spark.conf.get(INITIAL_PARTITIONS, None)
    if now not in (None, "", _set_here.get(session)):
        return
    _set_here[session] = str(partitions_for(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spark.conf.set(INITIAL_PARTITIONS, _set_here[session])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and snapshot tables.

    Read from ``spark.checkpoint.dir``; only a local test session without the
    setting gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master or ""):        # local-cluster is a cluster
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="kickstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kickstar") -> SparkSession:
    """Session for tests and the local bench (Spark UI off, no ports beyond Spark's own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
