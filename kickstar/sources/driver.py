"""Reader for the driver's parquet tables.

``table(spark, sf_dir, name)`` is a ``spark.read.parquet``; callers select the columns
they need and Catalyst pushes the projection and filters into the scan.

The DataFrame of each (session, directory, table) is built once and reused: the
plan is immutable, and reuse saves the file listing and footer read of every query.
No repartition is added after the scan — a large table arrives as many files and
splits; forcing a round-robin shuffle would move the whole table once more.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from kickstar.frames import path_exists, session_id, source_fingerprint

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
#: The tables that the warehouse is derived from.
WAREHOUSE_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")
_CACHE: dict[tuple, tuple[str, DataFrame]] = {}


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as its files are now. A plan is kept per session only as long as the files
    are the same (count, bytes, modification time: file-system metadata, no job)."""
    if name not in TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    where = path(sf_dir, name)
    key = (session_id(spark), where)
    now = source_fingerprint(spark, [where])
    if _CACHE.get(key, ("", None))[0] != now:
        _CACHE[key] = now, spark.read.parquet(where)
    return _CACHE[key][1]


def input_bytes(spark: SparkSession, sf_dir: str, names=WAREHOUSE_TABLES) -> int:
    """Bytes of the tables' files (file-system metadata, no job); a missing table has none."""
    out = 0
    for name in names:
        if path_exists(spark, path(sf_dir, name)):
            p = spark._jvm.org.apache.hadoop.fs.Path(path(sf_dir, name))
            out += p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return out


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the driver tables to ``spark.sql`` under their own names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
