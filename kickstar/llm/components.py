"""Connected components of a graph by alternating star contractions.

Each round points every vertex and its larger neighbours at the smallest neighbour (large
star), then its smaller neighbours at the smallest of them (small star); the graph is a set
of stars after a number of rounds logarithmic in the vertices. Edges live in tables in the
shared folder, one per round; a hub's edges are aggregated in each task first, and the joins
are on the vertex, which adaptive execution splits for a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickstar.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b), of any orderable type; ``root`` is the
    smallest vertex of its component. Loops, repeated and reversed edges are fine; edges with
    a null end are ignored. No edges: no rows."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # large star: neighbours above u go to the smallest of u and its neighbours
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: u and its neighbours below u go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionAll(low.select("a", F.col("m").alias("b"))).distinct())
        now = stored(small, "edges")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or state.n == 0:
            break
        before = state
    return now.select(F.col("a").alias("v"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
