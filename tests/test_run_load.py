"""A full warehouse load on staging derived from the smallest driver tables, in windows.

Mirrors the original run book: windows in sequence, the last one re-run → the re-run adds
0 fact rows; every member keeps exactly one current version; the journal has one
SUCCESS row per run."""
import tempfile

from pyspark.sql import functions as F

from kickstar.plans import load, staged, warehouse as WH
from tests.conftest import SF_SMALL


def test_windows_in_sequence_are_idempotent(spark):
    stg = {k: v.cache() for k, v in staged.staging_from_driver(spark, SF_SMALL).items()}
    root = tempfile.mkdtemp(prefix="kickstar-dw-")
    windows = [WH.LoadWindow("1990-01-01", "1996-12-31", "RUN_A"), WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_B"),
               WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_C")]
    results = [load.run_load(spark, stg, root, w, "2024-07-01") for w in windows]
    a, b, c = results
    assert a["team_match"] > 0 and b["team_match"] > 0 and b["transfer"] > 0 and b["player_valuation"] > 0
    assert all(c[k] == 0 for k in load.FACT_KEYS)                    # the re-run adds nothing
    assert c["fact_rows_before"] == c["fact_rows_after"] == b["fact_rows_after"]
    journal = spark.read.parquet(f"{root}/etl_batch").filter(F.col("v") == 6).collect()
    assert sorted((r.run_id, r.status) for r in journal) == [(1, "SUCCESS"), (2, "SUCCESS"), (3, "SUCCESS")]
    club = load._dim(spark, root, "club")
    assert club.filter("is_current").groupBy("club_id").count().filter("count > 1").count() == 0
    # facts point at members that exist (or at the -1 / -2 special members)
    tm = spark.read.parquet(f"{root}/fact_team_match")
    assert tm.join(club, "club_key", "left_anti").count() == 0
    assert tm.groupBy("match_key", "club_key").count().filter("count > 1").count() == 0
    # the stored rollup equals a recomputation from the fact
    mv = load.sinks.snapshot_read(spark, f"{root}/mv_club_season_standing")
    from kickstar.plans.questions import standing_rollup
    full = standing_rollup(tm)
    assert mv.select(*full.columns).exceptAll(full).count() == 0 and full.exceptAll(mv.select(*full.columns)).count() == 0
    rej = spark.read.parquet(f"{root}/etl_reject")
    assert rej.filter(F.col("batch_id") == "RUN_C").count() > 0
    assert rej.filter(F.col("batch_id").isin("RUN_A", "RUN_B") & F.col("source_table").isin(*load.FACT_SOURCES)) \
        .count() == 0                                               # purged at the start of each run


def test_new_club_versions_add_no_transfer_twice(spark):
    """The same window again after every club's stadium changed: no fact row is added."""
    stg = {k: v.cache() for k, v in staged.staging_from_driver(spark, SF_SMALL).items()}
    root = tempfile.mkdtemp(prefix="kickstar-dw-")
    first = load.run_load(spark, stg, root, WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_A"), "2024-07-01")
    moved = dict(stg, clubs=stg["clubs"].withColumn("stadium_name", F.lit("New Ground")))
    again = load.run_load(spark, moved, root, WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_B"), "2024-08-01")
    assert first["transfer"] > 0 and all(again[k] == 0 for k in load.FACT_KEYS)
    assert load._dim(spark, root, "club").groupBy("club_id").count().filter("count > 1").count() > 0    # there are new versions


def test_run_that_dies_is_found(spark, monkeypatch):
    """A run stopped after its facts: RUNNING in the journal, then FAILED; the next run makes
    up for the rollup and adds no row twice."""
    import pytest

    from kickstar.plans.questions import standing_rollup
    stg = {k: v.cache() for k, v in staged.staging_from_driver(spark, SF_SMALL).items()}
    root = tempfile.mkdtemp(prefix="kickstar-dw-")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(WH, "maintain_standing_rollup", stop)
        with pytest.raises(RuntimeError):
            load.run_load(spark, stg, root, WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_A"), "2024-07-01")
    assert [r.status for r in load.sinks.snapshot_read(spark, f"{root}/etl_batch").collect()] == ["RUNNING"]
    got = load.run_load(spark, stg, root, WH.LoadWindow("1990-01-01", "2030-12-31", "RUN_B"), "2024-07-01")
    assert got["team_match"] == 0
    assert sorted((r.run_id, r.status) for r in load.sinks.snapshot_read(spark, f"{root}/etl_batch").collect()) == [(1, "FAILED"), (2, "SUCCESS")]
    full = standing_rollup(spark.read.parquet(f"{root}/fact_team_match"))
    mv = load.sinks.snapshot_read(spark, f"{root}/mv_club_season_standing").select(*full.columns)
    assert mv.exceptAll(full).count() == 0 and full.exceptAll(mv).count() == 0
