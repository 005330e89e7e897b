"""Repair of conversations whose turns must alternate: (system), user, assistant, user, ...

Every conversation's rows, in order, are aligned with the strings of the grammar
``(s?(ua)+)?`` at the least cost of edits: keep a row, give it another role, delete it, insert
an empty one. Blank and repeated rows must be deleted, cut-off rows that stay cost extra.

* The alignment is Wagner and Fischer's. Its table runs from the last row to the first, over the
  number of grammar letters that are still to come: as all strings of the grammar end alike, one
  table holds the alignments with the strings of every length.
* Ukkonen's bands: the cost of the empty string or of a plain greedy repair is an incumbent; a
  cell whose least possible total is above it is never computed, so the table is a band around the
  rows that may stay.
* The audits (letters D, I, K, R of the edits, in order) of all lengths with the least cost are
  traced back together, letter by letter; those with a larger letter fall out, so the
  ASCII-least audit is left. Only every b-th row of the table is held, the rows between are
  computed again when the trace reaches them: memory is the root of the turns, times the band.

Only a role letter and a fault per row go into an alignment, and equal conversations of this
kind are aligned once per task. The rows with their texts meet the audits in a second pass, in
order, and are hashed as they stream by; no conversation is held in memory with its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickstar.llm.common import stored

# What counts as a character of a text, and how a whole text ends.
HAS_CHARACTER = r"[^\x20\x09-\x0D]"
WHOLE = r"[.!?][\x20\x09-\x0D]*\z"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3       # costs
FAR = 1 << 40
LETTERS = "DIKR"
ROLE = {"u": "user", "a": "assistant"}
MEMORY = 50_000             # alignments that a task remembers


class Alignment:
    """``roles``: s, u, a or another letter per row; ``faults``: b (blank), d (duplicate),
    t (cut off) or a dash per row."""

    def __init__(self, roles: str, faults: str):
        self.n, self.roles = len(roles), roles
        self.must = np.array([f in "bd" for f in faults], bool)
        extra = np.array([CUT_OFF if f == "t" else 0 for f in faults], np.int64)
        self.stay = np.where(self.must, FAR, KEEP + extra)          # cost of a row that stays with its role
        self.change = np.where(self.must, FAR, REROLE + extra)
        # least cost of a row whatever becomes of it, and how many rows may stay, from each row on
        self.least = np.concatenate([np.cumsum(np.minimum(self.stay, DELETE)[::-1])[::-1], [0]])
        self.may = np.concatenate([np.cumsum(~self.must[::-1])[::-1], [0]])
        self.budget = self._incumbent()
        self.cost, self.audit = self._solve()

    def _incumbent(self) -> int:
        """The cheaper of two plain repairs: delete all, or walk the rows and insert what is missing."""
        total, want, any_ = 0, "u", False
        for i, r in enumerate(self.roles):
            if self.must[i]:
                total += DELETE
            elif r == want or (r == "s" and not any_ and want == "u"):
                total += int(self.stay[i])
                any_, want = True, want if r == "s" else "a" if want == "u" else "u"
            elif r in "ua":
                total += int(self.stay[i]) + INSERT
                any_ = True
            else:
                total += DELETE
        kept = any_ and (want == "a" or not any(not m and r in "ua" for m, r in zip(self.must, self.roles)))
        if kept:        # the last pair is open, or there is only a system row
            total += INSERT if want == "a" else 2 * INSERT
        return min(total, DELETE * self.n)

    def _band(self, i: int) -> tuple[int, int]:
        """Numbers of letters to come, at row ``i``, that a repair within the budget can have."""
        spare = self.budget - int(self.least[0])
        may = int(self.may[i])
        low = max(0, may - spare) if spare < may else 0     # a deleted row costs 1 above its least at least
        return low, may + spare // INSERT + 1

    def _row(self, i: int, below: np.ndarray, low: int, low_below: int, high: int) -> np.ndarray:
        """Costs of rows i.. against the last low..high letters, from those of rows i+1.."""
        q = np.arange(low, high + 1)

        def at(x: np.ndarray) -> np.ndarray:
            k = x - low_below
            return np.where((k >= 0) & (k < len(below)), below[np.clip(k, 0, len(below) - 1)], FAR)

        fits = self._fits(i, q)
        out = np.minimum(DELETE + at(q), np.where(fits, self.stay[i], self.change[i]) + np.where(q > 0, at(q - 1), FAR))
        # inserts: the least of out[k] + INSERT * (q - k) over k <= q
        return np.minimum(np.minimum.accumulate(out - INSERT * q) + INSERT * q, FAR)

    def _fits(self, i: int, q: np.ndarray) -> np.ndarray:
        """Whether the row has the letter that stands before the last ``q - 1``: u for an even ``q``."""
        return (q % 2 == (0 if self.roles[i] == "u" else 1)) if self.roles[i] in "ua" else np.zeros(len(q), bool)

    def _end(self) -> tuple[np.ndarray, int]:
        low, high = self._band(self.n)
        return INSERT * np.arange(low, high + 1), low

    def _rows(self, top: int, row: np.ndarray, low: int, down_to: int) -> dict[int, tuple[np.ndarray, int]]:
        out = {top: (row, low)}
        for i in range(top - 1, down_to - 1, -1):
            a, b = self._band(i)
            row, low = self._row(i, row, a, low, b), a
            out[i] = (row, low)
        return out

    def _solve(self) -> tuple[int, str]:
        step = max(16, int(self.n ** 0.5))
        row, low = self._end()
        held = {self.n: (row, low)}
        pending = np.full(self.n + 1, FAR)      # rows before are deleted, the system row is still to come
        for top in range(self.n, 0, -step):
            bottom = max(0, top - step)
            block = self._rows(top, *held[top], bottom)
            held[bottom] = block[bottom]
            for i in range(top - 1, bottom - 1, -1):
                pending[i] = DELETE + pending[i + 1]
                if self.roles[i] == "s":
                    pending[i] = min(pending[i], self.stay[i] + self._pairs(*block[i + 1])[0])
        row, low = held[0]
        even = row[(-low) % 2::2]
        best = int(min(even.min() if len(even) else FAR, pending[0]))
        states = (low + np.flatnonzero(row == best))
        states = states[states % 2 == 0]
        open_ = pending[0] == best
        audit, i, block = [], 0, {}
        while True:
            if i not in block or (i < self.n and i + 1 not in block):
                top = min(t for t in held if t > i) if i < self.n else self.n
                block = self._rows(top, *held[top], i)
            row, low = block[i]
            if i == self.n:
                # inserts are left, as many as letters to come
                audit.append("I" * int(states[0]) if len(states) else "")
                return best, "".join(audit)
            below, low_below = block[i + 1]
            now = row[states - low] if len(states) else np.empty(0, np.int64)

            def after(x: np.ndarray) -> np.ndarray:
                k = x - low_below
                return np.where((k >= 0) & (k < len(below)), below[np.clip(k, 0, len(below) - 1)], FAR)

            def here(x: np.ndarray) -> np.ndarray:
                k = x - low
                return np.where((k >= 0) & (k < len(row)), row[np.clip(k, 0, len(row) - 1)], FAR)

            moves = {"D": DELETE + after(states) == now, "I": (states > 0) & (INSERT + here(states - 1) == now)}
            fits, next_ = self._fits(i, states), after(states - 1)
            moves["K"] = (states > 0) & fits & (self.stay[i] + next_ == now)
            moves["R"] = (states > 0) & ~fits & (self.change[i] + next_ == now)
            starts = np.empty(0, np.int64)
            delete_open = open_ and DELETE + pending[i + 1] == pending[i]
            if open_ and self.roles[i] == "s":
                least, ways = self._pairs(below, low_below)
                if self.stay[i] + least == pending[i]:
                    starts = ways
            letter = next(x for x in LETTERS if moves[x].any() or (x == "D" and delete_open) or (x == "K" and len(starts)))
            audit.append(letter)
            states = states[moves[letter]] - (letter != "D")
            if letter == "K":
                states = np.concatenate([states, starts])
            open_ = letter == "D" and delete_open
            i += letter != "I"

    @staticmethod
    def _pairs(row: np.ndarray, low: int) -> tuple[int, np.ndarray]:
        """The least cost against one pair or more, and the numbers of letters that reach it."""
        q = np.arange(low, low + len(row))
        ok = (q % 2 == 0) & (q >= 2)
        if not ok.any():
            return FAR, q[:0]
        least = int(row[ok].min())
        return (least, q[ok & (row == least)]) if least < FAR else (FAR, q[:0])


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo
    20: 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats the row, 4 makes
    it the user's. Nulls of any column read as one space, in the key too; conv_id and turn stay null."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return (rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind"))
            .filter("kind <> 0")
            .withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
            .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("kind", "copy"))


def _fault(conv: list[str], order: list[Column]) -> Column:
    """b, d, t or a dash: the first fault of a row."""
    seen = F.row_number().over(Window.partitionBy(*conv, "role", "text").orderBy(*order)) > 1
    return (F.when(~F.col("text").rlike(HAS_CHARACTER), "b").when(seen, "d").when(~F.col("text").rlike(WHOLE), "t").otherwise("-"))


def _audits(faulty: DataFrame) -> DataFrame:
    """One row per conversation of (known, conv, turn, letter, fault), sorted within it: counts,
    cost and audit."""
    names = ["known", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved: dict[tuple[str, str], tuple[int, str]] = {}
        key = None
        letters: list[str] = []
        faults: list[str] = []
        turns: list = [None, None, 0]       # first, last, distinct
        out: list[tuple] = []

        def close() -> None:
            roles, marks = "".join(x if x in ("s", "u", "a") else "?" for x in letters), "".join(faults)
            if (roles, marks) not in solved:
                if len(solved) >= MEMORY:
                    solved.clear()
                a = Alignment(roles, marks)
                solved[roles, marks] = (a.cost, a.audit)
            legal = ("su", "ua", "au")
            illegal = sum(x + y not in legal for x, y in zip(letters, letters[1:]))
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            out.append((*key, gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, *solved[roles, marks]))

        for batch in batches:
            for known, conv, turn, letter, fault in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key != (known, conv):
                    if key is not None:
                        close()
                    key, letters, faults, turns = (known, conv), [], [], [None, None, 0]
                letters.append(letter)
                faults.append(fault)
                if turn is not None and turn != turns[1]:
                    turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out.clear()
        if key is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    return faulty.mapInArrow(run, "known boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _edited(audit: str) -> Callable[[str, str], Iterator[tuple[str, str]]]:
    """A function that takes the rows of a conversation one by one and gives the rows that stand
    in their places; call it with (None, None) after the last."""
    at, want = 0, None

    def take(role: str | None, text: str | None) -> Iterator[tuple[str, str]]:
        nonlocal at, want
        while at < len(audit):
            letter = audit[at]
            if role is None and letter != "I":
                raise ValueError("the audit has more rows than the conversation")
            at += 1
            if letter == "D":
                return
            if letter == "K" and want is None and role[:1] == "s":
                yield role, text
                return
            now, want = (want or "u"), "a" if (want or "u") == "u" else "u"
            if letter == "I":
                yield ROLE[now], ""
                continue
            yield (role if letter == "K" else ROLE[now]), text
            return
    return take


def repaired_rows(rows: Iterator[tuple], audit: str) -> Iterator[tuple[str, str]]:
    """The rows (role, text) of a conversation after the audit's edits."""
    take = _edited(audit)
    for role, text in rows:
        yield from take(role, text)
    yield from take(None, None)


def repair(rows: DataFrame, all_convs: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text; other columns play no
    part): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 (of
    the repaired ``role:text`` rows, joined by newlines).

    Order: turn (nulls first), then role and text. A null role or text reads as one space. Rows
    of a null conv_id are one conversation. Conversations of ``all_convs`` without rows have
    zeros, an empty audit and the hash of the empty string; an empty table gives no rows. ids
    and turns are cast to long. A conversation streams through one task in order, as its hash must."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    conv = [F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")]
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    clean = rows.select(*conv, F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    dealt = stored(clean, "turns")
    # a row's texts are compared where the conversation is; only a letter and a fault go on
    audits = stored(_audits(dealt.repartition(n, "known", "conv").withColumn("fault", _fault(["known", "conv"], order[:1]))
                            .sortWithinPartitions("known", "conv", *order)
                            .select("known", "conv", "turn", F.substring("role", 1, 1).alias("letter"), "fault")), "audits")
    lines = (audits.select("known", "conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
             .unionAll(dealt.select("known", "conv", F.lit(1).alias("kind"), "turn", "role", "text"))
             .repartition(n, "known", "conv").sortWithinPartitions("known", "conv", "kind", *order))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = take = sha = None
        first = True
        out: list[tuple] = []

        def put(role: str | None, text: str | None) -> None:
            nonlocal first
            for own, words in take(role, text):
                sha.update((("" if first else "\n") + own + ":" + words).encode())
                first = False

        for batch in batches:
            for known, conv, kind, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if kind == 0:
                    if key is not None:
                        put(None, None)
                        out.append((*key, sha.hexdigest()))
                    key, take, sha, first = (known, conv), _edited(text), hashlib.sha256(), True
                else:
                    put(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["known", "conv", "sha"])
                out.clear()
        if key is not None:
            put(None, None)
            out.append((*key, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["known", "conv", "sha"])

    hashes = lines.select("known", "conv", "kind", "role", "text").mapInArrow(digest, "known boolean, conv long, sha string")
    convs = (rows if all_convs is None else all_convs).select(*conv).distinct()
    found = convs.join(audits, ["known", "conv"], "left").join(hashes, ["known", "conv"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
