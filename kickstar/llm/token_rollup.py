"""Token-count rollups kept up to date by signed deltas.

Layout of a store (any folder that all executors share):

* ``ledger``: the numbered commits; each names a batch, its attempt and the buckets that the
  attempt wrote anew;
* ``state/<attempt>/bucket=<b>``: signed rows per document, in buckets of its id: -1 for the
  count that is replaced or deleted and +1 for the new one;
* ``deltas/<attempt>``: the signed rows summed by source, language and tokenizer.

A batch is prepared in a folder of its own attempt, from the state of the last commit, and is
committed under the next number. If another batch was committed meanwhile, the number is taken
and the batch is prepared again, so no two batches ever replace the same counts. A job that
dies leaves nothing that readers see; a batch that comes again is recognised by its name and
changes nothing. Totals are the sums of the deltas of all commits.

A batch reads the buckets of its documents only. Once a bucket has been written ``compact``
times, a batch that touches it writes all its current counts, and what lies before is not read
again. Change rows are joined with the current counts by document; groups are summed in each
task before the shuffle, so a hot source is one row per task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.llm.token_blocks import worker_encoder
from kickstar.sources.commits import CommitLog

GROUP = ("source", "lang", "tokenizer")
STATE = "doc_id long, source string, lang string, tokenizer string, n_tokens long, sign int"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


class Rollup:
    """A store at ``path``. ``buckets`` is fixed by the first batch."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, compact: int = 8):
        self.spark, self.path, self.compact = spark, path.rstrip("/"), compact
        self.log = CommitLog(spark, f"{self.path}/ledger")
        self._buckets = buckets

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")

    def committed(self) -> dict[str, str]:
        """Attempt by committed batch."""
        return {e["batch"]: e["attempt"] for e in self.log.entries()}

    @staticmethod
    def _chains(entries: list[dict]) -> dict[int, list[str]]:
        """Attempts that hold a bucket's rows, since it was last written anew."""
        chains: dict[int, list[str]] = {}
        for e in entries:
            for b in e["whole"]:
                chains[b] = []
            for b in e["written"]:
                chains.setdefault(b, []).append(e["attempt"])
        return chains

    def _current(self, entries: list[dict], touched: list[int] | None = None) -> DataFrame:
        """Current counts, of the buckets ``touched`` or all."""
        paths = [f"{self.path}/state/{a}/bucket={b}" for b, attempts in self._chains(entries).items()
                 if touched is None or b in touched for a in attempts]
        if not paths:
            return self.spark.createDataFrame([], STATE).drop("sign")
        return (self.spark.read.schema(STATE).parquet(*paths).groupBy("doc_id", *GROUP, "n_tokens").agg(F.sum("sign").alias("n"))
                .filter("n > 0").drop("n"))

    def current(self) -> DataFrame:
        """(doc_id, source, lang, tokenizer, n_tokens): what counts now, from the signed rows."""
        return self._current(self.log.entries())

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens); groups without documents are left out."""
        paths = [f"{self.path}/deltas/{e['attempt']}" for e in self.log.entries()]
        deltas = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        return (deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .filter("n_docs <> 0 or n_tokens <> 0"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (doc_id, source, lang, tokenizer, n_tokens, deleted) once; False if
        the batch is committed already.

        A row replaces all counts of its document; ``deleted`` rows only take them away.
        Several rows of one document in a batch: a row with ``deleted`` wins, then the largest
        (tokenizer, n_tokens, source, lang). Rows with a null doc_id name no document and are
        not counted. Null sources and languages are groups of their own, a null n_tokens is 0.
        An empty batch is committed and changes nothing; other columns are not read."""
        if "=" in batch or "/" in batch:
            raise ValueError("a batch name has no = and no /")
        while True:
            entries = self.log.entries()
            if any(e["batch"] == batch for e in entries):
                return False
            entry = self._prepare(batch, changes, entries)
            if self._commit(len(entries) + 1, entry):
                return True

    def _prepare(self, batch: str, changes: DataFrame, entries: list[dict]) -> dict:
        """Write the batch's rows against the state after ``entries``; the commit that makes them count."""
        attempt = uuid.uuid4().hex
        n = entries[0]["buckets"] if entries else self._buckets
        # the largest (deleted, tokenizer, n_tokens, source, lang) of a document, in plain columns
        rows = changes.filter("doc_id is not null").select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("deleted", F.lit(False)).alias("deleted"),
            F.col("tokenizer").cast("string").alias("tokenizer"), F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"),
            F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
        new = (rows.groupBy("doc_id").agg(F.max(F.struct("deleted", "tokenizer", "n_tokens", "source", "lang")).alias("r"))
               .select("doc_id", "r.*").withColumn("bucket", self._bucket(n)))
        aside = f"{self.path}/aside/{attempt}"
        new.write.parquet(aside)
        new = self.spark.read.parquet(aside)
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())       # at most `buckets` numbers
        chains = self._chains(entries)
        whole = [b for b in touched if len(chains.get(b, [])) >= self.compact]
        now = self._current(entries, touched)
        old = now.join(new.select("doc_id"), "doc_id", "left_semi").withColumn("sign", F.lit(-1))
        added = new.filter("not deleted").select("doc_id", *GROUP, "n_tokens", F.lit(1).alias("sign"))
        names = ["doc_id", *GROUP, "n_tokens", "sign"]
        signed = added.select(names).unionByName(old.select(names)).withColumn("part", F.lit("signed"))
        stay = now.withColumn("bucket", self._bucket(n)).filter(F.col("bucket").isin(whole) if whole else F.lit(False)) \
            .join(new.select("doc_id"), "doc_id", "left_anti").withColumn("sign", F.lit(1)).select(names).withColumn("part", F.lit("stay"))
        both = f"{aside}-rows"
        signed.unionByName(stay).withColumn("bucket", self._bucket(n)).write.parquet(both)
        done = self.spark.read.parquet(both)
        is_whole = F.col("bucket").isin(whole) if whole else F.lit(False)
        # a bucket that is written anew holds what counts now, the others what changes
        state = done.filter(F.when(is_whole, F.col("sign") == 1).otherwise(F.col("part") == "signed")).select(*names, "bucket")
        state.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/state/{attempt}")
        (done.filter("part = 'signed'").groupBy(*GROUP)
         .agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
         .write.parquet(f"{self.path}/deltas/{attempt}"))
        there = {r.bucket for r in state.select("bucket").distinct().collect()}
        for path in (aside, both):
            fs, p = self.log._fs(path)
            fs.delete(p, True)
        return {"batch": batch, "attempt": attempt, "buckets": n, "written": sorted(there), "whole": whole}

    def _commit(self, number: int, entry: dict) -> bool:
        return self.log.commit(number, entry)


def token_counts(docs: DataFrame, tokenizer: str, version: str, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Change rows for :meth:`Rollup.apply` with the number of ids that the tokenizers file
    ``tokenizer`` gives each text (null: 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                n = np.array([len(x) for x in encoder([t or "" for t in part.column(3).to_pylist()])], np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), pa.array(n)], ["doc_id", "source", "lang", "n_tokens"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "doc_id long, source string, lang string, n_tokens long")
            .withColumns({"tokenizer": F.lit(version), "deleted": F.lit(False)}))
