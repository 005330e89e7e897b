"""Table sinks: appends, reject log, purge, and versioned snapshots.

No table format with MERGE is available offline, so a dimension is a sequence of
snapshot directories ``<root>/<table>/v=<n>``; a merge writes version n+1 from a
plan that reads version n, and readers take the highest version. A path is never
overwritten by a plan that reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kickstar.frames import path_exists


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None):
    """A partitioned write is rebalanced on the partition columns first: each task writes
    one value's slice (AQE splits a hot value, merges small ones), not a file per value."""
    if partition_by:
        return df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    return df.write.mode(mode)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    _writer(df, "append", partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    _writer(df, "overwrite", partition_by).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, or an empty frame of ``schema`` when nothing was written yet (the
    path does not exist); a path that cannot be read is an error."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that its own job wrote and has read to the end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def reject_sink(rejects: DataFrame, path: str) -> None:
    """Append rejects, partitioned by source table (so a purge rewrites only its partitions)."""
    append(rejects, path, ["source_table"])


def reject_purge(spark: SparkSession, path: str, source_tables: list[str]) -> None:
    """Clear earlier rejects of the given source tables (run start): their partitions are
    deleted, no other row is read or written. Run again after a crash, it goes on."""
    for name in source_tables:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/source_table={name}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions ``<root>/v=<n>`` that were written to the end; a folder that a dead run left
    behind is none."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and path_exists(spark, f"{root.rstrip('/')}/{n}/_SUCCESS"))


def snapshot_read(spark: SparkSession, root: str) -> DataFrame | None:
    """Highest complete version of a snapshot table, or None if there is none."""
    versions = snapshot_versions(spark, root)
    return spark.read.parquet(f"{root.rstrip('/')}/v={versions[-1]}") if versions else None


def snapshot_write(df: DataFrame, root: str, version: int) -> str:
    """Write version ``version``; a complete version is never overwritten. The rows are written
    aside and appear by a rename, so a run that dies leaves no half version and blocks nobody."""
    path, aside = f"{root.rstrip('/')}/v={version}", f"{root.rstrip('/')}/_aside-{uuid.uuid4().hex}"
    spark = df.sparkSession
    if path_exists(spark, f"{path}/_SUCCESS"):
        raise FileExistsError(path)
    df.write.parquet(aside)
    fs, target = _fs(spark, path)
    fs.delete(target, True)             # without a marker: left behind by a dead run
    fs.rename(_fs(spark, aside)[1], target)
    return path
