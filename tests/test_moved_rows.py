"""Loads move their rows as seldom, and as narrow, as they can; the results stay the same."""
import datetime as dt

from pyspark.sql import functions as F

from kickstar.operators import route as R
from kickstar.plans import warehouse as WH
from tests.test_loads import _dims

TRANSFERS = ("player_id string, transfer_date string, transfer_season string, from_club_id string, to_club_id string, "
             "transfer_fee string, market_value_in_eur string, batch_id string, source_row long")
ROWS = [("7", "2021-07-01", "20/21", "5", "6", "5.000", "4", "B1", 1), ("7", "2021-07-01", "20/21", "5", "6", "9.000", "4", "B2", 2),
        ("7", "2023-07-01", "23/24", "5", "6", "7.000", "4", "B1", 3), ("8", "2023-07-02", "23/24", "999", "6", None, "4", "B1", 4),
        ("8", "2023-7-3", "23/24", "5", "6", "1", "4", "B1", 5), ("8", "2010-07-02", "23/24", "6", "5", "1", "4", "B1", 6),
        ("8", "2010-07-03", "23/24", "6", "5", "-1", "4", "B1", 7), ("8", "2023-07-04", "23/24", "6", "5", "x", "4", "B1", 8),
        ("8", None, "23/24", "6", "5", "1", "-4", "B1", 9)]
NONE = "player_key long, date_key int, from_club_key long, to_club_key long"
ALL = WH.LoadWindow("2020-01-01", "2024-12-31", "B1")


def _own(spark):
    """A session in which no join is a broadcast, as on large tables."""
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.shuffle.partitions", "2")
    return own


def test_rejects_are_one_pass_and_those_of_both_streams(spark):
    s = spark.createDataFrame([("1", "5"), ("x", "5"), (None, "5"), ("2", "-5"), ("3", None), ("y", "-1")], "k string, v string")
    casts, rules = {"k": "int", "v": "int"}, [(F.col("c_k").isNull(), "missing"), (F.col("c_v") < 0, "negative")]
    ok, bad = R.cast_or_reject(s, casts)
    _, broken = R.validate_or_reject(ok, rules)
    once = R.rejected(s, casts, rules)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, bad.unionByName(broken).collect()), key=repr)
    _, rej = WH.load_fact_transfer(spark.createDataFrame(ROWS, TRANSFERS), _dims(spark), spark.createDataFrame([], NONE), ALL)
    assert sorted((r.natural_key, r.reason) for r in rej.collect()) == [
        ("8|2010-07-03|6|5", "negative fee"), ("8|2023-07-04|6|5", "cast error"), ("8|6|5", "missing required value")]
    assert "Union" not in rej._jdf.queryExecution().optimizedPlan().toString()


def test_a_row_without_a_date_is_in_the_window_if_no_rule_forbids_it(spark):
    df = spark.createDataFrame([(1, dt.date(2021, 1, 1)), (2, dt.date(2010, 1, 1)), (3, None)], "k int, d date")
    valid, rej = R.validate_or_reject(df, [(F.col("k") > 9, "big")], R.load_window_filter(F.col("d"), "2020-01-01", "2024-12-31"))
    assert sorted(r.k for r in valid.collect()) == [1, 3] and rej.count() == 0


def test_transfers_outside_the_window_are_left_before_the_rows_are_spread(spark):
    fact, _ = WH.load_fact_transfer(spark.createDataFrame(ROWS, TRANSFERS), _dims(spark), spark.createDataFrame([], NONE), ALL)
    below = fact._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1]
    assert "2020-01-01" in below and "2024-12-31" in below


def test_the_first_anti_join_finds_transfers_as_the_deduplication_spread_them(spark):
    own = _own(spark)
    stg = own.createDataFrame(ROWS, TRANSFERS)
    first, _ = WH.load_fact_transfer(stg, _dims(own), own.createDataFrame([], NONE), WH.LoadWindow("2020-01-01", "2022-12-31", "B0"))
    loaded = own.createDataFrame(first.collect(), first.schema)
    assert [(r.date_key, r.transfer_fee_eur) for r in loaded.collect()] == [(20210701, 9)]
    fact, _ = WH.load_fact_transfer(stg, _dims(own), loaded, ALL)
    assert sorted((r.date_key, r.from_club_key, r.transfer_fee_eur) for r in fact.collect()) == [
        (20230701, 11, 7), (20230702, -1, None), (20230703, 11, 1)]
    again, _ = WH.load_fact_transfer(stg, _dims(own), own.createDataFrame(loaded.collect() + fact.collect(), first.schema), ALL)
    assert again.count() == 0                       # an unknown club and a date in another spelling: found by the keys
    plan = fact._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not [x for x in plan if "hashpartitioning(player_id#" in x and "to_club_id#" in x]        # spread once, as the groups


def test_columns_that_follow_are_added_after_the_rows_were_moved(spark):
    from kickstar import frames
    df = spark.createDataFrame([(1, 2), (1, 3), (2, None), (None, 5)], "k int, v int")
    after = lambda d: d.select("k", (F.col("v") * 2).alias("twice"), F.lit("text").alias("t"))
    got = frames.materialize(df, "after", ["k"], ["k", "twice"], after=after)
    assert got.columns == ["k", "twice", "t"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, after(df).collect()), key=repr)
    from kickstar.plans import star
    from tests.conftest import SF_SMALL
    for base, rows in ((star._team_match_base, star._team_match_rows), (star._appearance_base, star._appearance_rows), (star._transfer_base, star._transfer_rows)):
        assert len(base(spark, SF_SMALL).columns) < len(rows(spark, SF_SMALL).columns)
    # customers meet the orders, not the lines
    plan = star._transfer_base(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    joined = plan.split("Join LeftOuter")[1]
    assert "o_orderkey" in joined and "l_shipdate" not in joined


def test_shuffle_files_of_a_write_go_with_it_and_a_given_setting_stays(spark):
    from kickstar.frames import SHUFFLE_CLEANUP, shuffles_removed
    own = spark.newSession()
    with shuffles_removed(own), shuffles_removed(own):
        assert own.conf.get(SHUFFLE_CLEANUP) == "true"
    assert own.conf.get(SHUFFLE_CLEANUP, None) is None
    own.conf.set(SHUFFLE_CLEANUP, "false")
    with shuffles_removed(own):
        assert own.conf.get(SHUFFLE_CLEANUP) == "false"
    assert own.conf.get(SHUFFLE_CLEANUP) == "false"


def test_csv_files_are_ranges_of_the_rows_and_go_once_staged(spark, tmp_path):
    import glob
    import os

    from kickstar.plans import staged
    from kickstar.sources import sinks, staging
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", "3")
    rows = own.createDataFrame([(str(k % 4), f"c{k}", k) for k in range(40)], "game_id string, club_id string, source_row long")
    rows = rows.withColumns({c: F.lit(c) for c in staged.CLUB_GAME_ORDER})
    files = staged.write_csv_files(own, {"club_games": rows}, str(tmp_path / "files"))
    assert len(glob.glob(f"{files['club_games']}/part-*")) == 3
    read = staging.stage_csv(own, files, str(tmp_path / "staging"), dt.datetime(2024, 7, 1), "B")["club_games"]
    sinks.remove(own, files["club_games"])
    assert not os.path.exists(files["club_games"])
    assert [(r.source_row, r.club_id, r.is_win) for r in read.orderBy("source_row").collect()] == [
        (k + 1, f"c{k}", f'free "text", line one\nand line {k}') for k in range(40)]
