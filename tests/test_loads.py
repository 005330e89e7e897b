"""Fact loads from staging text tables (fixtures), code audit, manager and inferred members."""
import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from kickstar import fixed
from kickstar.plans import warehouse as WH
from kickstar.sources import sinks, staging
from kickstar.operators.route import REJECT_SCHEMA

W = WH.LoadWindow("2020-01-01", "2024-12-31", "B1")


def _dims(spark):
    return {
        "match": spark.createDataFrame([(1, 100), (2, 200)], "match_key long, game_id long"),
        "club": spark.createDataFrame([(11, 5, True), (12, 6, True), (-1, -1, True), (-2, -2, True)],
                                      "club_key long, club_id long, is_current boolean"),
        "competition": spark.createDataFrame([(31, "GB1"), (-2, "-2")], "competition_key int, competition_id string"),
        "season": spark.createDataFrame([(2020, 2020, "20/21"), (2023, 2023, "23/24")],
                                        "season_key int, season_start_year int, season_short string"),
        "manager": spark.createDataFrame([(1, "Ole Solskjaer"), (-1, fixed.UNKNOWN)],
                                         "manager_key long, manager_name string"),
        "player": spark.createDataFrame([(21, 7, dt.date(2000, 2, 29), True), (22, 8, None, True)],
                                        "player_key long, player_id long, date_of_birth date, is_current boolean"),
    }


def _games(spark):
    return spark.createDataFrame([("100", "GB1", "2020", "2020-09-12 00:00:00", "B0", 1),
                                  ("200", "GB1", "2023", "2023-09-12", "B0", 2)],
                                 "game_id string, competition_id string, season string, date string, "
                                 "batch_id string, source_row long")


def test_load_team_match(spark):
    cg = spark.createDataFrame([
        ("100", "5", "2", "-1", "Ole Solskjær", "6", "1", "  ", "Home", "B1", 1),
        ("100", "6", "1", "3", None, "5", "2", "Ole Solskjær", "Away", "B1", 2),
        ("200", "5", "x", "", "A", "6", "0", "B", "Home", "B1", 3),                 # cast reject
        ("200", "6", "", "", "A", "5", "0", "B", "Away", "B1", 4),                  # rule reject (goals missing)
    ], "game_id string, club_id string, own_goals string, own_position string, own_manager_name string, "
       "opponent_id string, opponent_goals string, opponent_manager_name string, hosting string, "
       "batch_id string, source_row long")
    dims = _dims(spark)
    empty = spark.createDataFrame([], "match_key long, club_key long")
    fact, rej = WH.load_fact_team_match(cg, _games(spark), dims, empty, W)
    got = sorted((r.club_key, r.opponent_club_key, r.is_home, r.points, r.is_win, r.manager_key,
                  r.opponent_manager_key, r.league_position, r.season_key, r.competition_key, r.date_key)
                 for r in fact.collect())
    assert got == [(11, 12, 1, 3, 1, 1, -1, None, 2020, 31, 20200912),
                   (12, 11, 0, 0, 0, -1, 1, 3, 2020, 31, 20200912)]
    assert sorted(r.reason for r in rej.collect()) == ["cast error", "missing required value"]
    # re-run against the loaded rows adds nothing
    again, _ = WH.load_fact_team_match(cg, _games(spark), dims, fact, W)
    assert again.count() == 0


def test_load_appearance(spark):
    ap = spark.createDataFrame([
        ("a1", "100", "7", "5", "GB1", "0", "0", "1", "0", "90", "2020-09-12", "B1", 1),
        ("a1", "100", "7", "5", "GB1", "1", "0", "1", "0", "90", "2020-09-12", "B2", 2),   # later batch wins
        ("a2", "100", "8", "6", "GB1", "0", "0", "0", "0", "131", "2020-09-12", "B1", 3),  # minutes > 130
        ("a3", "100", "8", "6", "XX", "0", "0", "0", "0", "130", "2020-09-12", "B1", 4),   # unknown comp -> -1
        ("a4", "100", "8", "6", "GB1", "0", "0", "-1", "0", "10", "2020-09-12", "B1", 5),  # negative goals
        ("a5", "100", "8", "6", "GB1", "0", "0", "0", "0", "10", "2010-09-12", "B1", 6),   # outside window
    ], "appearance_id string, game_id string, player_id string, player_club_id string, competition_id string, "
       "yellow_cards string, red_cards string, goals string, assists string, minutes_played string, date string, "
       "batch_id string, source_row long")
    fact, rej = WH.load_fact_player_appearance(ap, _games(spark), _dims(spark),
                                               spark.createDataFrame([], "appearance_id string"), W)
    got = sorted((r.appearance_id, r.player_key, r.club_key, r.competition_key, r.yellow_cards, r.season_key)
                 for r in fact.collect())
    assert got == [("a1", 21, 11, 31, 1, 2020), ("a3", 22, 12, -1, 0, 2020)]
    assert sorted(r.reason for r in rej.collect()) == ["minutes out of range", "negative count"]


def test_load_transfer(spark):
    tr = spark.createDataFrame([
        ("7", "2023-07-01", "23/24", "5", "6", "5000000.000", "4000000", "B1", 1),
        ("7", "2023-08-01", "23/24", "6", "515", None, "1000", "B1", 2),          # undisclosed fee, to -> -2
        ("8", "2023-08-02", "23/24", "75", "5", "0", None, "B1", 3),               # free, from -> -1, no dob
        ("8", "2023-08-03", "23/24", "5", "6", "-1", "0", "B1", 4),                # negative fee: reject
    ], "player_id string, transfer_date string, transfer_season string, from_club_id string, to_club_id string, "
       "transfer_fee string, market_value_in_eur string, batch_id string, source_row long")
    empty = spark.createDataFrame([], "player_key long, date_key int, from_club_key long, to_club_key long")
    fact, rej = WH.load_fact_transfer(tr, _dims(spark), empty, W)
    got = sorted((r.date_key, r.from_club_key, r.to_club_key, r.transfer_type_key, r.transfer_fee_eur,
                  r.fee_premium_eur, r.age_at_transfer, r.is_youth_transfer, r.season_key) for r in fact.collect())
    assert got == [(20230701, 11, 12, 4, 5_000_000, 1_000_000, 23, 0, 2023),
                   (20230801, 12, -2, 1, None, None, 23, 0, 2023),
                   (20230802, -1, 11, 2, 0, None, None, None, 2023)]
    assert [r.reason for r in rej.collect()] == ["negative fee"]
    again, _ = WH.load_fact_transfer(tr, _dims(spark), fact, W)
    assert again.count() == 0


def test_code_audit_and_members(spark):
    f = spark.createDataFrame
    staging = {
        "games": f([("1", "GB1"), ("2", "ZZ9"), ("3", " ")], "game_id string, competition_id string"),
        "club_games": f([("1", "5"), ("2", "5"), (" 2 ", "6"), ("3", "5")], "game_id string, club_id string"),
        "appearances": f([("a1", "GB1", "7"), ("a2", "ZZ9", "999"), ("a3", "", "x")], "appearance_id string, competition_id string, player_id string"),
        "player_valuations": f([("7", "2024-01-01 00:00", "YY1"), ("7", "2024-01-02", None)],
                               "player_id string, date string, player_club_domestic_competition_id string"),
        "transfers": f([("999", "2024-01-01"), ("7", "2024-01-01")], "player_id string, transfer_date string"),
    }
    audit = WH.code_audit(staging, _dims(spark), "B1")
    known = {str(r.player_id) for r in _dims(spark)["player"].collect()}
    assert "7" in known and "999" not in known
    assert sorted((r.source_table, r.natural_key) for r in audit.collect()) == [
        ("appearances", "a2"), ("appearances", "a2"), ("club_games", " 2 |6"), ("club_games", "2|5"), ("player_valuations", "7|2024-01-01"),
        ("transfers", "999|2024-01-01")]
    cg = spark.createDataFrame([("Ole Solskjær", "Ole Solskjaer"), (" ", "Jürgen Klopp")],
                               "own_manager_name string, opponent_manager_name string")
    names = sorted(r.manager_name for r in WH.manager_members(cg).collect())
    assert names == sorted(["Ole Solskjaer", "Jürgen Klopp", fixed.UNKNOWN])         # one folded member
    dim = _dims(spark)["manager"]
    loaded = WH.insert_only(dim, WH.manager_members(cg), "manager_name", "manager_key")
    assert sorted((r.manager_key, r.manager_name) for r in loaded.collect())[-1] == (2, "Jürgen Klopp")
    ids = spark.createDataFrame([("9", "Named FC", "B1"), ("515", "x", "B1"), ("5", "known", "B1"), ("abc", None, "B1"), (" 7 ", None, "B1"), (None, "y", "B1")],
                                "to_club_id string, to_club_name string, batch_id string")
    inf = WH.inferred_clubs([ids, ids.select("to_club_id")], _dims(spark)["club"])
    assert sorted((r.club_id, r.club_name, r.club_type) for r in inf.collect()) == [
        (7, "CLB 7", fixed.INFERRED_CLUB_NAME), (9, "Named FC", fixed.INFERRED_CLUB_NAME)]
    assert [r.natural_key for r in WH.inferred_club_rejects([ids], "B1").collect()] == ["abc"]


def test_staging_csv_audit_and_reconcile(spark):
    root = tempfile.mkdtemp(prefix="kickstar-stg-")
    path = os.path.join(root, "player_valuations.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("player_id,date,market_value_in_eur,current_club_name,current_club_id,"
                 "player_club_domestic_competition_id\n")
        fh.write('1,2024-01-01,100,"Club, with comma",5,GB1\n')
        fh.write('2,2024-01-02,,"multi\nline",6,\n')
    raw = staging.csv_raw_source(spark, path, staging.STAGING_COLUMNS["player_valuations"])
    assert all(f.dataType.simpleString() == "string" for f in raw.schema.fields)
    bid = staging.batch_id_for(dt.datetime(2024, 2, 1, 13, 5, 9))
    assert bid == "BATCH_20240201_130509"
    staged = staging.audit_columns(raw, bid, dt.datetime(2024, 2, 1, 13, 5, 9))
    r = sorted(staged.collect(), key=lambda x: x.player_id)
    assert r[0].current_club_name == "Club, with comma" and r[1].current_club_name == "multi\nline"
    assert r[1].market_value_in_eur is None and r[0].source_file == "player_valuations.csv"
    paths = staging.staging_full_refresh({"player_valuations": staged}, os.path.join(root, "stg"))
    back = spark.read.parquet(paths["player_valuations"])
    rep = staging.source_reconcile(spark, {"player_valuations": path}, {"player_valuations": back}).collect()
    assert rep[0].status == "PASS" and rep[0].source_rows == 2 and rep[0].bytes == os.path.getsize(path)
    lines = spark.read.text(path).agg(F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("string")).first()[0]
    assert rep[0].line_fingerprint == lines
    # files of the same name in two folders each keep one row of their own
    for sub, text in (("a", "x\n1\n"), ("b", "x\n2\n" * 1000), ("c", "")):
        os.makedirs(os.path.join(root, "many", sub))
        with open(os.path.join(root, "many", sub, "same.csv"), "w", encoding="utf-8") as fh:
            fh.write(text)
    got = staging.file_fingerprints(spark, "t", os.path.join(root, "many", "*")).collect()
    assert sorted((r.bytes, r.lines) for r in got) == [(4, 2), (4000, 2000)]
    assert len({r.line_fingerprint for r in got}) == 2 and len({r.file for r in got}) == 2


def test_reject_sink_and_purge(spark):
    root = tempfile.mkdtemp(prefix="kickstar-rej-")
    path = os.path.join(root, "etl_reject")
    ts = dt.datetime(2024, 1, 1)
    rows = [("B1", "transfers", "k1", "negative fee", ts), ("B1", "clubs", "k2", "cast error", ts)]
    sinks.reject_sink(spark.createDataFrame(rows, REJECT_SCHEMA), path)
    sinks.reject_purge(spark, path, ["transfers"])
    left = spark.read.parquet(path).collect()
    assert [(r.source_table, r.natural_key) for r in left] == [("clubs", "k2")]
    snap = os.path.join(root, "dim_club")
    sinks.snapshot_write(spark.range(3), snap, 1)
    sinks.snapshot_write(spark.range(5), snap, 2)
    assert sinks.snapshot_read(spark, snap).count() == 5


def test_dimension_rows_that_do_not_cast_are_rejected(spark):
    f = spark.createDataFrame
    clubs = f([("1", "A", "100"), ("abc", "B", "100"), ("2", "C", "many"), (None, "D", "5"), ("3", "E", " ")], "club_id string, name string, stadium_seats string") \
        .selectExpr("*", "'GB1' AS domestic_competition_id", "'g' AS stadium_name", "'B1' AS batch_id", "1L AS source_row")
    teams = f([("50", "N"), ("x", "M")], "national_team_id string, name string") \
        .selectExpr("*", "'c' AS country_name", "'UEFA' AS confederation", "'B1' AS batch_id", "1L AS source_row")
    players = f([("1", "180", "3", "1999-01-01", "2027-06-30 00:00"), ("2", "tall", "3", None, None), ("3", None, None, "1999-13-01", None),
                 ("4", "99999", None, None, None), ("5", None, "few", None, "soon")],
                "player_id string, height_in_cm string, international_caps string, date_of_birth string, contract_expiration_date string") \
        .selectExpr("*", "'n' AS name", "'b' AS country_of_birth", "'c' AS country_of_citizenship", "'p' AS position", "'s' AS sub_position",
                    "'l' AS foot", "'a' AS agent_name", "'B1' AS batch_id", "1L AS source_row")
    games = f([("1", "5"), ("2", "full"), ("z", "5"), ("4", None)], "game_id string, attendance string") \
        .selectExpr("*", "'Final' AS round", "'s' AS stadium", "'r' AS referee", "'4' AS home_club_formation", "'4' AS away_club_formation",
                    "'B1' AS batch_id", "1L AS source_row")
    got = WH.club_incoming(clubs, teams, _dims(spark)["competition"].withColumns(
        {c: F.lit("x") for c in ("competition_name", "country_name", "confederation")}))
    assert sorted(r.club_id for r in got.collect()) == [1, 3, 50]
    assert sorted(r.player_id for r in WH.player_incoming(players).collect()) == [1]
    assert sorted(r.game_id for r in WH.match_incoming(games).collect()) == [1, 4]
    log = WH.dimension_rejects({"clubs": clubs, "national_teams": teams, "players": players, "games": games}, "B1")
    assert sorted((r.source_table, r.natural_key) for r in log.collect()) == [
        ("clubs", "2"), ("clubs", "abc"), ("games", "2"), ("games", "z"), ("national_teams", "x"),
        ("players", "2"), ("players", "3"), ("players", "4"), ("players", "5")]
