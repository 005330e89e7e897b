"""A log of numbered commits in a shared folder, on any file system that Spark knows.

Entry ``n`` is the folder ``<root>/<n>`` with one small file. It is written aside first and
becomes visible by the rename of its folder, whole or not at all; of several writers of one
number the first wins, and each reads the entry back to learn whether it was its own. A
writer names the number after the last one it has read, so it only succeeds if nothing was
committed since: whatever it prepared from that state is still right.

A writer that dies leaves a folder aside that no reader looks at. (File systems whose rename of a
folder is not one step, such as some object stores, need one writer at a time.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

DIGITS = 12


class CommitLog:
    """Entries are dictionaries (JSON)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _load(self, number: int) -> dict:
        fs, p = self._fs(f"{self.root}/{number:0{DIGITS}d}/entry")
        stream = fs.open(p)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def numbers(self) -> list[int]:
        fs, p = self._fs(self.root)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(x) for x in names if len(x) == DIGITS and x.isdigit())

    def entries(self) -> list[dict]:
        return [self._load(n) for n in self.numbers()]

    def last(self) -> tuple[int, dict]:
        """(number, entry) of the newest commit; (0, {}) if there is none."""
        n = max(self.numbers(), default=0)
        return n, self._load(n) if n else {}

    def commit(self, number: int, entry: dict) -> bool:
        """Make ``entry`` the commit ``number``; False if there is another one already."""
        mine = uuid.uuid4().hex
        fs, aside = self._fs(f"{self.root}/aside-{mine}")
        _, target = self._fs(f"{self.root}/{number:0{DIGITS}d}")
        if fs.exists(target):
            return False
        fs.mkdirs(aside)
        stream = fs.create(self._fs(f"{self.root}/aside-{mine}/entry")[1], False)
        stream.write(bytearray(json.dumps({**entry, "commit_id": mine}).encode()))
        stream.close()
        fs.rename(aside, target)
        won = self._load(number)["commit_id"] == mine
        if not won:         # the folder is still aside, or was moved into the winner's
            for left in (aside, self._fs(f"{self.root}/{number:0{DIGITS}d}/aside-{mine}")[1]):
                fs.delete(left, True)
        return won
