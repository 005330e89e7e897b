"""Stored facts: what the questions read equals the direct derivation from the driver
tables, and a season filter prunes the stored season partitions."""

from pyspark.sql import functions as F

from kickstar.plans import star
from tests.conftest import SF_SMALL


def _same_rows(a, b):
    assert a.columns == b.columns
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stored_facts_equal_direct_derivation(spark):
    star.store_facts(spark, SF_SMALL)
    tm = star._team_match_rows(spark, SF_SMALL)
    _same_rows(star.stored_team_match(spark, SF_SMALL), tm)
    _same_rows(star.player_appearance(spark, SF_SMALL), star._appearance_rows(spark, SF_SMALL))
    _same_rows(star.transfer(spark, SF_SMALL), star._transfer_rows(spark, SF_SMALL))
    _same_rows(star.player_valuation(spark, SF_SMALL), star._valuation_rows(spark, SF_SMALL))
    # asking for the manager keeps inner-join semantics with part
    with_manager = star.team_match(spark, SF_SMALL, with_manager=True)
    assert with_manager.count() == tm.filter(F.col("__has_part")).count()
    assert with_manager.columns[-1] == "manager_key"


def test_season_range_prunes_partitions(spark):
    span = star.season_span(["1997/98"])
    df = star.team_match(spark, SF_SMALL, ship_range=span)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "season_key" in plan.split("PartitionFilters")[1][:200]
    assert df.select("season_key").distinct().collect() in ([], [(1997,)])
    direct = star._team_match_rows(spark, SF_SMALL).filter(F.col("season_key") == 1997)
    assert df.count() == direct.count()


def test_fresh_store_is_private_and_equal(spark):
    star.store_facts(spark, SF_SMALL)
    shared = star.stored_transfer(spark, SF_SMALL)
    star.store_facts(spark, SF_SMALL, reuse=False)
    fresh = star.stored_transfer(spark, SF_SMALL)
    assert not set(fresh.inputFiles()) & set(shared.inputFiles())
    _same_rows(fresh, shared)


def test_competitions_are_found_in_the_dimension(spark):
    """Ids of any form (a dimension with real ids such as GB1) name their members."""
    from kickstar.plans import questions as Q
    tm = star.team_match(spark, SF_SMALL)
    for ids in (["COMP31"], ["COMP31", "COMP72", "GB1"], ["nope"]):
        keys = [r.competition_key for r in star.dim_competition(spark, SF_SMALL).filter(F.col("competition_id").isin(*ids)).collect()]
        _same_rows(Q.in_competitions(spark, SF_SMALL, tm, ids), tm.filter(F.col("competition_key").isin(*keys)))


def test_competition_ids_have_no_pattern(spark, monkeypatch):
    from kickstar.plans import questions as Q
    tm = star.team_match(spark, SF_SMALL)
    real = star.dim_competition(spark, SF_SMALL).withColumn("competition_id", F.when(F.col("competition_id") == "COMP31", "GB1").otherwise("ES1"))
    monkeypatch.setattr(star, "dim_competition", lambda *_: real)
    want = tm.filter("competition_key = 31")
    assert want.count() > 0
    _same_rows(Q.in_competitions(spark, SF_SMALL, tm, ["GB1"]), want)


def test_season_span_needs_years_in_every_label():
    assert star.season_span(["1998/99", "1996/97"]) == ("1996-01-01", "1999-01-01")
    assert star.season_span(["1998/99", "Unknown"]) is None and star.season_span([]) is None


def test_replaced_source_is_read_anew(spark, tmp_path):
    from kickstar.sources.driver import table
    spark.range(3).write.parquet(str(tmp_path / "region.parquet"))
    assert table(spark, str(tmp_path), "region").count() == 3
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "region.parquet"))
    assert table(spark, str(tmp_path), "region").count() == 5
