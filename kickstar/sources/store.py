"""Tables of a warehouse folder whose changes appear together or not at all.

A run writes new folders below ``<root>/data/<run>`` and touches nothing that readers see. The
commit log (:mod:`kickstar.sources.commits`) then names, in one step, the folders that make up
every table from now on. Readers see the state of the last commit; a run that dies at any
point changes nothing, and the next run starts from the same state. A run that was overtaken
by another one cannot commit.

* A table is a list of parts. An append adds one; a replacement names new ones instead.
* Tables in buckets (dimensions) have a part per bucket of a key, so that a change replaces the
  buckets it touches only.
* Facts have a key index: for every file, the 32-bit hashes of a key in sorted chunks. The files
  that rows of a batch can collide with are found from the index alone, so that a load joins a
  few files instead of the whole fact. A hash in common is only a hint that the file must be
  read; no collision of keys is missed.
* The journal has a row per run that began: SUCCESS if it committed, FAILED if another run began
  after it, else RUNNING.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickstar.sources.commits import CommitLog

CHUNK_BITS = 12         # an index row holds the hashes of a file that share their top 12 bits
INDEX = "file string, chunk int, hashes array<int>"
#: Partition folders repeat a column under this name, so that single files hold all columns.
FOLDER = "part_"


class Overtaken(RuntimeError):
    """Another run committed since this one began."""


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class Store:
    """The tables below ``root``, as of the last commit when it was made or refreshed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits")
        self.refresh()

    def refresh(self) -> None:
        self.number, self.entry = self.log.last()

    @property
    def info(self) -> dict:
        return self.entry.get("info", {})

    def _table(self, name: str) -> dict | None:
        return self.entry.get("tables", {}).get(name)

    def paths(self, name: str) -> list[str]:
        t = self._table(name)
        return [f"{self.root}/{p['path']}" for p in t["parts"]] if t else []

    def read(self, name: str) -> DataFrame | None:
        """The table, or None if no run has written it."""
        t = self._table(name)
        if t is None:
            return None
        return read_parts(self.spark, self.paths(name), T.StructType.fromJson(json.loads(t["schema"])))

    def read_buckets(self, name: str, buckets: Sequence[int]) -> DataFrame | None:
        t, wanted = self._table(name), set(buckets)
        if t is None:
            return None
        paths = [f"{self.root}/{p['path']}" for p in t["parts"] if p.get("bucket") in wanted]
        return read_parts(self.spark, paths, T.StructType.fromJson(json.loads(t["schema"])))

    def candidate_files(self, name: str, keys: DataFrame) -> list[str]:
        """Files of fact ``name`` that may hold a key of ``keys`` (the index's key columns): their
        names, a list as long as the fact has files."""
        index = self.read(f"index_{name}")
        if index is None:
            return []
        wanted = _hashed(keys).groupBy("chunk").agg(F.collect_set("hash").alias("wanted"))
        hits = index.join(wanted, "chunk").filter(F.arrays_overlap("hashes", "wanted")).select("file").distinct()
        return sorted(r.file for r in hits.collect())

    def read_files(self, name: str, files: Sequence[str]) -> DataFrame | None:
        t = self._table(name)
        return None if t is None else read_parts(self.spark, list(files), T.StructType.fromJson(json.loads(t["schema"])))

    def journal(self) -> list[dict]:
        """Runs by start: run, batch_id, started_at, status and what the run's commit says."""
        fs, p = self.log._fs(f"{self.root}/started")
        if not fs.exists(p):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(p))
        done = {e["run"]: e["info"] for e in self.log.entries()}
        out = []
        for i, name in enumerate(names):
            started, batch, run = name.split("=")
            status = "SUCCESS" if run in done else "FAILED" if i + 1 < len(names) else "RUNNING"
            out.append({"run": run, "batch_id": batch, "started_at": started, "status": status, **done.get(run, {})})
        return out

    def begin(self, batch_id: str, started_at: dt.datetime | None = None) -> "Run":
        self.refresh()
        return Run(self, batch_id, started_at or dt.datetime.now())


def read_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files or folders with one schema; their folders are not looked at, as files hold all columns."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths) if paths else spark.createDataFrame([], schema)


def _hashed(keys: DataFrame) -> DataFrame:
    h = F.hash(*[F.col(c) for c in keys.columns if c != "file"])
    cols = ["file"] if "file" in keys.columns else []
    return keys.select(*cols, F.shiftrightunsigned(h, 32 - CHUNK_BITS).alias("chunk"), h.alias("hash"))


class Run:
    """One run of a load: writes beside the tables, then commits. ``run.read`` sees what the run
    has written so far."""

    def __init__(self, store: Store, batch_id: str, started_at: dt.datetime):
        self.store, self.spark, self.batch_id = store, store.spark, batch_id
        self.base = store.number
        self.id = uuid.uuid4().hex
        self.tables = {k: {"schema": v["schema"], "parts": list(v["parts"])} for k, v in store.entry.get("tables", {}).items()}
        fs, p = store.log._fs(f"{store.root}/started/{started_at:%Y%m%dT%H%M%S%f}={batch_id}={self.id}")
        fs.create(p, False).close()

    def _view(self) -> Store:
        view = object.__new__(Store)
        view.spark, view.root, view.log = self.spark, self.store.root, self.store.log
        view.number, view.entry = self.base, {"tables": self.tables, "info": self.store.info}
        return view

    def read(self, name: str) -> DataFrame | None:
        return self._view().read(name)

    def read_buckets(self, name: str, buckets: Sequence[int]) -> DataFrame | None:
        return self._view().read_buckets(name, buckets)

    def _write(self, name: str, df: DataFrame, partition_by: str | None = None) -> str:
        path = f"data/{self.id}/{name}-{uuid.uuid4().hex[:8]}"
        if partition_by:
            df = df.withColumn(FOLDER + partition_by, F.col(partition_by)).hint("rebalance", FOLDER + partition_by)
            df.write.partitionBy(FOLDER + partition_by).parquet(f"{self.store.root}/{path}")
        else:
            df.write.parquet(f"{self.store.root}/{path}")
        return path

    def _put(self, name: str, df: DataFrame, parts: list[dict], keep: list[dict]) -> None:
        self.tables[name] = {"schema": df.schema.json(), "parts": keep + parts}

    def replace(self, name: str, df: DataFrame) -> None:
        self._put(name, df, [{"path": self._write(name, df)}], [])

    def append(self, name: str, df: DataFrame, partition_by: str | None = None, key: Sequence[str] = ()) -> DataFrame:
        """Add rows; with ``key`` their files get an index. Returns the rows as they were written."""
        old = self.tables.get(name, {"parts": []})["parts"]
        path = self._write(name, df, partition_by)
        self._put(name, df, [{"path": path}], old)
        written = read_parts(self.spark, [f"{self.store.root}/{path}"], df.schema)
        if key:
            rows = written.select(F.col("_metadata.file_path").alias("file"), *key)
            index = _hashed(rows).groupBy("file", "chunk").agg(F.sort_array(F.collect_set("hash")).alias("hashes"))
            self.append(f"index_{name}", index)
        return written

    def replace_buckets(self, name: str, df: DataFrame, key: Sequence[str], buckets: int, touched: Sequence[int]) -> None:
        """Write the buckets ``touched`` anew with the rows of ``df``, which are all theirs; other
        buckets keep their parts."""
        keep = [p for p in self.tables.get(name, {"parts": []})["parts"] if p["bucket"] not in set(touched)]
        path = f"data/{self.id}/{name}-{uuid.uuid4().hex[:8]}"
        (df.withColumn(FOLDER + "bucket", bucket_of(key, buckets)).hint("rebalance", FOLDER + "bucket")
         .write.partitionBy(FOLDER + "bucket").parquet(f"{self.store.root}/{path}"))
        fs, p = self.store.log._fs(f"{self.store.root}/{path}")
        there = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(p) if "=" in s.getPath().getName())
        self._put(name, df, [{"path": f"{path}/{FOLDER}bucket={b}", "bucket": b} for b in there], keep)

    def commit(self, **info) -> int:
        """Make all that the run wrote visible; returns the commit's number."""
        entry = {"run": self.id, "batch_id": self.batch_id, "tables": self.tables, "info": info}
        if not self.store.log.commit(self.base + 1, entry):
            raise Overtaken(f"commit {self.base + 1} is another run's; start again from its state")
        self.store.refresh()
        return self.base + 1
