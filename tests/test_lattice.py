"""Stored lattice and version history: answers from the smallest node, appended batches, merges."""
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from kickstar.frames import literal_frame
from kickstar.plans import questions as Q
from kickstar.plans import load, store_queries as SQ, warehouse as WH
from kickstar.plans.history import scd2_history
from kickstar.plans.lattice import Lattice
from kickstar.sources.store import Store
from tests.conftest import SF_SMALL, rows

LATTICE = Lattice("t", (("a", "b", "c"), ("a", "b"), ("a",), ("c",)), (("n", "1"), ("v", "v")), (("players", "p"),))


def test_lattice_equals_the_fact_after_every_batch(spark):
    rnd = random.Random(1)
    data = [(rnd.randrange(4), rnd.choice([None, 1, 2]), rnd.randrange(30), rnd.randrange(-5, 50), rnd.choice([0, 1, 32767, 32768, 70000, rnd.randrange(500)])) for _ in range(900)]
    fact = spark.createDataFrame(data, "a int, b int, c int, v int, p long")
    store, done = Store(spark, tempfile.mkdtemp(prefix="kickstar-mv-")), None
    for k in range(3):
        part = fact.filter(F.pmod(F.xxhash64("a", "c", "v"), F.lit(3)) == k)
        run = store.begin(f"b{k}")
        LATTICE.append(run, part)
        run.commit()
        done = part if done is None else done.unionAll(part)
        for level in (("a", "b", "c"), ("a", "b"), ("b",), ("c",), ()):
            want = done.groupBy(*level).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), F.count_distinct("p").alias("players"))
            assert rows(LATTICE.answer(store, level)) == rows(want), level
        some = LATTICE.answer(store, ("b",), F.col("c") < 10)
        assert rows(some) == rows(done.filter("c < 10").groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"), F.count_distinct("p").alias("players")))
    assert LATTICE.node_for(store, ("a",)) == ("a",) and LATTICE.node_for(store, ("b",)) == ("a", "b") and LATTICE.node_for(store, ("c", "b")) == ("a", "b", "c")
    with pytest.raises(KeyError):
        LATTICE.node_for(store, ("x",))


def test_distinct_rows_stay_small_with_keys_far_apart(spark):
    """A row of a distinct node holds one long, not a bitmap of 4 KB, so its bytes follow the fact's rows."""
    fact = spark.range(400).selectExpr("cast(id % 4 as int) a", "cast(id % 2 as int) b", "cast(id as int) c", "1 v", "id * 100000 p")
    store = Store(spark, tempfile.mkdtemp(prefix="kickstar-mv-"))
    run = store.begin("b")
    LATTICE.append(run, fact)
    run.commit()
    for node in LATTICE.nodes:
        bits = store.read(LATTICE.table(node, "players"))
        assert bits.schema["bits"].dataType.simpleString() == "bigint" and bits.count() <= 400
    assert LATTICE.answer(store, ()).first().players == 400


def test_stored_standing_is_read(spark):
    plan = Q.bq_mv_season_rates(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    files = Q.stored_standing(spark, SF_SMALL, "season").inputFiles()
    assert files and all("mv_standing_season" in f for f in files)
    assert plan.count("Relation") == 1
    assert any("mv_standing_season_club" in f for f in Q.stored_standing(spark, SF_SMALL).inputFiles())


def test_history_equals_merges_one_after_the_other(spark):
    rnd, dates = random.Random(4), ["2024-01-01", "2024-02-01", "2024-02-02", "2024-05-01", "2024-09-01"]
    data = []
    for d in dates:
        for k in range(1, 60):
            if rnd.random() < 0.8:
                data.append((k, d, rnd.choice(["n1", "n2", None]), rnd.choice(["x", "x", "y", None]), rnd.choice(["p", "p", "p", "q"])))
    batches = spark.createDataFrame(data, "player_id long, batch_date string, full_name string, agent_name string, position string")
    schema = "player_key long, player_id long, full_name string, agent_name string, position string, effective_date date, expiry_date date, is_current boolean"
    dim = literal_frame(spark, [(-1, -1, "U", "U", "U", load.FIRST, load.OPEN, True)], schema)
    for d in dates:
        dim = WH.scd_merge(dim, batches.filter(F.col("batch_date") == d).drop("batch_date"), SQ.HISTORY_SPEC, d)
        dim = spark.createDataFrame(dim.collect(), schema)
    got = scd2_history(batches, SQ.HISTORY_SPEC, "batch_date")
    cols = ("player_key", "player_id", "full_name", "agent_name", "position", "effective_date", "expiry_date", "is_current")
    assert rows(got, *cols) == rows(dim.filter("player_key > 0"), *cols)
    assert scd2_history(batches.limit(0), SQ.HISTORY_SPEC, "batch_date").count() == 0
