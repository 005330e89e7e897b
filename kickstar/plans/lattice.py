"""A stored lattice of additive aggregates, and the rule that answers a level from it.

A node holds the measures of a fact at some of its columns: sums, counts, and exact distinct
counts as bitmaps. A bitmap row says which keys of one bucket of 64 consecutive keys occur, as
the bits of one long; rows of a bucket are united, and as buckets are disjoint their bit counts
add up to the exact count at any level. A row holds one key at least, so a node never has more
of them than the fact has rows, however many keys there are, and where keys lie close it has
up to 64 times fewer.

A batch of fact rows is aggregated once, to the finest node; each coarser node gets its rows from
the smallest node that holds its columns. Batches append rows; a read sums or unites them, so no
batch touches what others wrote. A level is answered from the node with the fewest rows among
those that hold its columns; the fact is never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickstar.sources.store import Run, Store


@dataclass(frozen=True)
class Lattice:
    """``nodes``: column sets, the finest first, which holds all others; ``sums``: (measure,
    fact column or "1" for a row count); ``distinct``: (measure, key column of type long, from 0)."""
    name: str
    nodes: tuple[tuple[str, ...], ...]
    sums: tuple[tuple[str, str], ...]
    distinct: tuple[tuple[str, str], ...] = ()

    def table(self, node: Sequence[str], measure: str | None = None) -> str:
        return "_".join(["mv", self.name, *node] + ([measure] if measure else []))

    def append(self, run: Run, rows: DataFrame) -> None:
        """Add the aggregates of new fact rows to every node."""
        finest = self.nodes[0]
        value = lambda c: F.count(F.lit(1)) if c == "1" else F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long")
        sums = {finest: run.append(self.table(finest), rows.groupBy(*finest).agg(*[value(c).alias(m) for m, c in self.sums]))}
        maps: dict[tuple, dict] = {finest: {}}
        for m, c in self.distinct:
            key = F.col(c).cast("long")
            bits = (rows.filter(key >= 0).groupBy(*finest, F.shiftright(key, 6).alias("bucket"))
                    .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(63).cast("int"))).alias("bits")))
            maps[finest][m] = run.append(self.table(finest, m), bits)
        counts = {finest: sums[finest].count()}
        for node in sorted(self.nodes[1:], key=len, reverse=True):
            source = min((n for n in sums if set(node) <= set(n)), key=lambda n: counts[n])
            sums[node] = run.append(self.table(node), sums[source].groupBy(*node).agg(*[F.sum(m).alias(m) for m, _ in self.sums]))
            maps[node] = {m: run.append(self.table(node, m), maps[source][m].groupBy(*node, "bucket").agg(F.bit_or("bits").alias("bits")))
                          for m, _ in self.distinct}
            counts[node] = sums[node].count()

    def node_for(self, store: Store, level: Sequence[str]) -> tuple[str, ...]:
        """The smallest stored node that holds the level's columns."""
        holding = [n for n in self.nodes if set(level) <= set(n)]
        if not holding:
            raise KeyError(f"no node of {self.name} holds {list(level)}")
        return min(holding, key=lambda n: (store.read(self.table(n)).count(), len(n)))

    def answer(self, store: Store, level: Sequence[str], where: Column | None = None) -> DataFrame:
        """The measures at ``level`` (an empty level: one row of totals)."""
        node = self.node_for(store, list(level) + ([] if where is None else _columns(where, self.nodes[0])))

        def read(measure: str | None = None) -> DataFrame:
            df = store.read(self.table(node, measure))
            return df if where is None else df.filter(where)

        out = read().groupBy(*level).agg(*[F.sum(m).alias(m) for m, _ in self.sums])
        for m, _ in self.distinct:
            united = read(m).groupBy(*level, "bucket").agg(F.bit_or("bits").alias("bits"))
            count = united.groupBy(*level).agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long").alias(m))
            if level:
                same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in level]
                out = out.alias("l").join(count.alias("r"), same, "left").select("l.*", F.coalesce(f"r.{m}", F.lit(0)).alias(m))
            else:
                out = out.crossJoin(count)          # one row each
        return out


def _columns(condition: Column, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that the condition mentions."""
    import re
    said = set(re.findall(r"\w+", str(condition)))
    return [n for n in names if n in said]
