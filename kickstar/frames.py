"""Small helpers for plans: literal rows built in the JVM, per-session memoisation."""

from __future__ import annotations

import functools
import hashlib
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A DataFrame of literal rows written in code (bounded by construction), built as
    ``inline(array(struct(...)))`` in the JVM — no Python-side data transfer."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def session_id(spark: SparkSession) -> str:
    """Identity of a session that no later session shares."""
    return spark._jsparkSession.sessionUUID()


_MEMO: dict[tuple, DataFrame] = {}


def _memo_key(spark: SparkSession, fn: Callable, args: tuple, kwargs: dict) -> tuple:
    where = [source_fingerprint(spark, [a]) for a in args if isinstance(a, str) and "/" in a and path_exists(spark, a)]
    return session_id(spark), *where, fn.__module__, fn.__qualname__, args, tuple(sorted(kwargs.items()))


def session_memo(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build a plan once per (session, arguments, state of the folder an argument names): a
    replaced source gives a new plan. DataFrames are immutable, so reuse is safe."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, *args, **kwargs) -> DataFrame:
        key = _memo_key(spark, fn, args, kwargs)
        df = _MEMO.get(key)
        if df is None:
            df = fn(spark, *args, **kwargs)
            _MEMO[key] = df
        return df

    def remember(spark: SparkSession, *args, value: DataFrame, **kwargs) -> None:
        """Make ``value`` the memoised result for these arguments."""
        _MEMO[_memo_key(spark, fn, args, kwargs)] = value

    wrapper.remember = remember
    return wrapper


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, int] = {}
_cleaning_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends; else they stay on the disks until
    the driver happens to collect its garbage, through all later steps. Nothing reads them again: a
    write is planned anew each time. A setting that the session was given stays."""
    session = session_id(spark)
    with _cleaning_lock:
        if session in _cleaning or spark.conf.get(SHUFFLE_CLEANUP, None) in (None, ""):
            _cleaning[session] = _cleaning.get(session, 0) + 1
            spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            if session in _cleaning:
                _cleaning[session] -= 1
                if not _cleaning[session]:
                    del _cleaning[session]
                    spark.conf.unset(SHUFFLE_CLEANUP)


def materialize(df: DataFrame, label: str = "mat", partition_by: Sequence[str] | None = None,
                sort_by: Sequence[str] | None = None, after: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Cut lineage: write the rows once as parquet under the shared ``spark.checkpoint.dir``
    and read them back (one execution; ``checkpoint()`` would compute the plan twice
    unless it were cached). Recomputed tasks then read the same files.

    ``partition_by`` writes one directory per value (no extra shuffle: each task writes
    its own rows per value), so filters on those columns prune directories on read; the
    rows are read back with the written schema (no partition-type inference). ``after`` gives
    the rows to write from ``df``."""
    from kickstar.session import checkpoint_dir
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/kickstar-{label}-{uuid.uuid4().hex}"
    _write(df, path, partition_by, sort_by, after)
    return spark.read.schema(after(df).schema).parquet(path).select(*after(df).columns)


def _write(df: DataFrame, path: str, partition_by: Sequence[str] | None,
           sort_by: Sequence[str] | None = None, after: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Write parquet; a partitioned write is first rebalanced on the partition columns, so
    each task writes one value's slice (AQE splits a hot value into several tasks and
    merges small ones) instead of every task writing a small file into every folder.
    ``sort_by`` (starting with the partition columns) orders the rows inside each task, so
    row-group min/max statistics let filters on those columns skip row groups. ``after`` adds
    columns that follow from others once the rows were moved, so they are not moved with them."""
    if partition_by:
        df = after(df.hint("rebalance", *partition_by))
        if sort_by:
            df = df.sortWithinPartitions(*sort_by)
    else:
        df = after(df)
    with shuffles_removed(df.sparkSession):
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS or an object store)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def source_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Identity of source tables from file-system metadata: bytes and file count (content
    summary) and the latest modification time of the table's path — no Spark job and no
    file contents read. A changed source gives a new fingerprint."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    parts = []
    for p in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = jpath.getFileSystem(conf)
        summary = fs.getContentSummary(jpath)
        mtime = fs.getFileStatus(jpath).getModificationTime()
        parts.append(f"{p}|{summary.getFileCount()}|{summary.getLength()}|{mtime}")
    return hashlib.sha1("\n".join(parts).encode()).hexdigest()[:20]


def _finished_copy(spark: SparkSession, base: str) -> str | None:
    """A sub-folder of ``base`` whose writer finished (``_SUCCESS`` marker), if any."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    for st in sorted(fs.listStatus(root), key=lambda x: x.getPath().getName()):
        if st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            return st.getPath().toString()
    return None


def stored(df: DataFrame, label: str, fingerprint: str, partition_by: Sequence[str] | None = None,
           reuse: bool = True, sort_by: Sequence[str] | None = None,
           after: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """A derived table kept in the shared checkpoint folder under a folder named by the
    sources' fingerprint, so later sessions reuse it instead of deriving it again.

    Every writer writes its own sub-folder, so concurrent sessions never commit into the
    same directory; a reader takes any copy whose writer finished (``_SUCCESS`` marker)
    and never reads partial files. ``reuse=False`` always writes a fresh private copy."""
    from kickstar.session import checkpoint_dir
    spark = df.sparkSession
    if not reuse:
        return materialize(df, label, partition_by, sort_by, after)
    base = f"{checkpoint_dir(spark).rstrip('/')}/kickstar-store/{label}-{fingerprint}"
    path = _finished_copy(spark, base)
    if path is None:
        path = f"{base}/{uuid.uuid4().hex}"
        _write(df, path, partition_by, sort_by, after)
    return spark.read.schema(after(df).schema).parquet(path).select(*after(df).columns)
