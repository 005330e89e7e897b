"""Atomic runs over a store: stopped runs, buckets that change, files that a batch can meet."""
import tempfile

import pytest
from pyspark.sql import functions as F

from kickstar.plans import atomic_load as AL
from kickstar.plans import load, staged, warehouse as WH
from kickstar.plans.questions import standing_rollup
from kickstar.sources import sinks
from kickstar.sources.commits import CommitLog
from kickstar.sources.store import Overtaken, Run, Store
from tests.conftest import SF_SMALL, rows

ALL = WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_B")


@pytest.fixture(scope="module")
def stg(spark):
    return {k: v.cache() for k, v in staged.staging_from_driver(spark, SF_SMALL).items()}


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


def contents(spark, root):
    """The store's tables as counts and digests, by name."""
    s = Store(spark, root)
    return s.number, {n: tuple(s.read(n).agg(F.count(F.lit(1)), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first())
                      for n in s.entry.get("tables", {}) if not n.startswith("index_") and n != "etl_reject"}


def test_same_tables_as_the_plain_load(spark, stg):
    one, two = tempfile.mkdtemp(prefix="kickstar-dw-"), tempfile.mkdtemp(prefix="kickstar-dw-")
    windows = [WH.LoadWindow("1990-01-01", "1996-12-31", "RUN_A"), ALL, ALL]
    plain = [load.run_load(spark, stg, one, w, "2024-07-01") for w in windows[:2]]
    atomic = [AL.load_atomic(spark, stg, two, w, "2024-07-01") for w in windows]
    for a, b in zip(plain, atomic):
        assert {k: a[k] for k in load.FACT_KEYS} == {k: b[k] for k in load.FACT_KEYS}
    assert all(atomic[2][k] == 0 for k in load.FACT_KEYS) and not any(atomic[2]["buckets"].values())
    store = Store(spark, two)
    for name in load.DIM_SCHEMAS:
        assert same(store.read(f"dim_{name}"), load._dim(spark, one, name)), name
    for name in load.FACT_KEYS:
        assert same(store.read(f"fact_{name}"), spark.read.parquet(f"{one}/fact_{name}")), name
    mv, full = store.read("mv_club_season_standing"), standing_rollup(store.read("fact_team_match"))
    assert same(full, mv)
    assert [(r["batch_id"], r["status"]) for r in store.journal()] == [("RUN_A", "SUCCESS"), ("RUN_B", "SUCCESS"), ("RUN_B", "SUCCESS")]


def test_run_stopped_anywhere_changes_nothing(spark, stg, monkeypatch):
    root = tempfile.mkdtemp(prefix="kickstar-dw-")
    AL.load_atomic(spark, stg, root, WH.LoadWindow("1990-01-01", "1996-12-31", "RUN_A"), "2024-07-01")
    moved = dict(stg, clubs=stg["clubs"].withColumn("stadium_name", F.concat("stadium_name", F.lit(" new"))))
    before, steps = contents(spark, root), 0
    real = Run._write
    while True:
        left = [steps]

        def write(self, *a, **k):
            if not left[0]:
                raise RuntimeError("stopped")
            left[0] -= 1
            return real(self, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(Run, "_write", write)
            try:
                AL.load_atomic(spark, moved, root, ALL, "2024-08-01")
                break
            except RuntimeError:
                assert contents(spark, root) == before
        steps += 5
    after = contents(spark, root)
    assert steps > 9 and after[0] == before[0] + 1 and after[1]["fact_team_match"] != before[1]["fact_team_match"]
    status = [r["status"] for r in Store(spark, root).journal()]
    assert status[0] == status[-1] == "SUCCESS" and set(status[1:-1]) == {"FAILED"}


def test_overtaken_run_does_not_commit(spark, stg):
    root = tempfile.mkdtemp(prefix="kickstar-dw-")
    first, second = Store(spark, root).begin("one"), Store(spark, root).begin("two")
    first.replace("t", spark.range(3))
    second.replace("t", spark.range(5))
    assert Store(spark, root).read("t") is None
    second.commit()
    with pytest.raises(Overtaken):
        first.commit()
    assert Store(spark, root).read("t").count() == 5
    assert [r["status"] for r in Store(spark, root).journal()] == ["FAILED", "SUCCESS"]


def test_commit_log(spark):
    log = CommitLog(spark, tempfile.mkdtemp(prefix="kickstar-log-"))
    assert log.last() == (0, {}) and log.commit(1, {"a": 1}) and not log.commit(1, {"a": 2}) and log.commit(2, {"a": 3})
    assert [e["a"] for e in log.entries()] == [1, 3] and log.last()[0] == 2


def test_merge_writes_changed_buckets_only(spark):
    """One member in a hundred changes: at most its buckets are written, and the result is that of
    the plain merge."""
    root = tempfile.mkdtemp(prefix="kickstar-dw-")
    clubs = spark.range(1, 1001).select(F.col("id").alias("club_id"), F.concat(F.lit("C"), "id").alias("club_name"), F.lit("Club").alias("club_type"),
                                        F.lit("X").alias("country_name"), F.lit("Y").alias("confederation"), F.lit("L1").alias("current_league_id"),
                                        F.lit("League").alias("current_league_name"), F.lit("Ground").alias("stadium_name"), F.lit("S").alias("stadium_capacity_band"))
    store = Store(spark, root)
    run = store.begin("a")
    assert len(AL.merge_dimension(run, "club", clubs, WH.CLUB_SPEC, "2024-01-01")) == AL.BUCKETS
    run.commit()
    before = {p["bucket"]: p["path"] for p in store.entry["tables"]["dim_club"]["parts"]}
    changed = clubs.withColumn("stadium_name", F.when(F.col("club_id") % 100 == 0, "Arena").otherwise(F.col("stadium_name"))) \
        .unionByName(clubs.limit(2).withColumn("club_id", F.col("club_id") + 5000))
    plain = WH.scd_merge(store.read("dim_club"), changed, WH.CLUB_SPEC, "2024-07-01")
    want = rows(plain)
    run = store.begin("b")
    touched = AL.merge_dimension(run, "club", changed, WH.CLUB_SPEC, "2024-07-01")
    run.commit()
    parts = {p["bucket"]: p["path"] for p in store.entry["tables"]["dim_club"]["parts"]}
    assert {b for b in parts if parts[b] != before[b]} == set(touched) and len(touched) <= 12
    assert rows(store.read("dim_club")) == want
    assert AL.merge_dimension(store.begin("c"), "club", changed, WH.CLUB_SPEC, "2024-08-01") == []


def test_batch_meets_only_files_it_can_collide_with(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="kickstar-dw-"))
    for k in range(6):
        run = store.begin(f"b{k}")
        fact = spark.range(k * 1000, k * 1000 + 1000).select(F.col("id").alias("match_key"), (F.lit(2000) + k).alias("season_key"))
        run.append("fact_t", fact, "season_key", ["match_key"])
        run.commit()
    files = [f for f in store.candidate_files("fact_t", spark.range(0, 6000).select(F.col("id").alias("match_key")))]
    assert len(files) >= 6
    some = store.candidate_files("fact_t", spark.range(2100, 2110).select(F.col("id").alias("match_key")))
    assert 1 <= len(some) < len(files) and all("season_key=2002" in f for f in some)
    found = store.read_files("fact_t", some)
    assert found.filter("match_key between 2100 and 2109").count() == 10 and found.agg(F.max("season_key")).first()[0] == 2002
    scanned = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(scanned)) < int(str(store.read("fact_t")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) / 3
    assert store.candidate_files("fact_t", spark.range(99_000, 99_001).select(F.col("id").alias("match_key"))) == []
    assert store.candidate_files("none", spark.range(1)) == []


def test_dead_snapshot_blocks_nobody(spark):
    """A version folder without a marker is no version; the next run writes it."""
    import os
    root = tempfile.mkdtemp(prefix="kickstar-dw-")
    os.makedirs(f"{root}/t/v=1/_temporary")
    assert sinks.snapshot_read(spark, f"{root}/t") is None
    sinks.snapshot_write(spark.range(4), f"{root}/t", 1)
    assert sinks.snapshot_read(spark, f"{root}/t").count() == 4
    with pytest.raises(FileExistsError):
        sinks.snapshot_write(spark.range(4), f"{root}/t", 1)
    os.makedirs(f"{root}/bad")
    with pytest.raises(Exception):
        open(f"{root}/bad/part.parquet", "w").write("no parquet")
        sinks.read_or_empty(spark, f"{root}/bad", "a int").count()
