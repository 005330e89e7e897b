"""Dimension source preparation (staging text -> merge input) fixtures."""
import datetime as dt

from kickstar import fixed
from kickstar.plans import warehouse as WH


def test_competition_incoming(spark):
    comps = spark.createDataFrame([
        ("GB1", "premier-league", "domestic_league", None, "189", "England", "europa", "B1", 1),
        ("CL", None, "international_cup", None, "-1", None, "UEFA", "B1", 2),
        ("GB1", "premier-league-2", "domestic_league", None, "189", "England", "europa", "B2", 3),
    ], "competition_id string, name string, type string, sub_type string, country_id string, country_name string, "
       "confederation string, batch_id string, source_row long")
    countries = spark.createDataFrame([("189", "England", "B1", 1)], "country_id string, country_name string, "
                                                                     "batch_id string, source_row long")
    out = {r.competition_id: r for r in WH.competition_incoming(comps, countries).collect()}
    assert out["GB1"].competition_name == "premier-league-2" and out["GB1"].confederation == "UEFA"
    assert out["CL"].competition_name == fixed.UNKNOWN and out["CL"].country_name == fixed.INTERNATIONAL
    assert out["GB1"].competition_sub_type == fixed.UNKNOWN


def test_club_incoming(spark):
    clubs = spark.createDataFrame([("5", None, "GB1", "Anfield", "61276", "B1", 1),
                                   ("6", "Other", "ZZ", None, "0", "B1", 2)],
                                  "club_id string, name string, domestic_competition_id string, stadium_name string, "
                                  "stadium_seats string, batch_id string, source_row long")
    teams = spark.createDataFrame([("3299", "England", "England", "EUROPA", "B1", 3)],
                                  "national_team_id string, name string, country_name string, confederation string, "
                                  "batch_id string, source_row long")
    comp = spark.createDataFrame([("GB1", "Premier League", "England", "UEFA")],
                                 "competition_id string, competition_name string, country_name string, "
                                 "confederation string")
    out = {r.club_id: r for r in WH.club_incoming(clubs, teams, comp).collect()}
    assert out[5].club_name == "CLB 5" and out[5].country_name == "England" and out[5].current_league_name == \
        "Premier League" and out[5].stadium_capacity_band == ">= 60.000"
    assert out[6].country_name == fixed.UNKNOWN and out[6].stadium_capacity_band == fixed.UNKNOWN
    assert out[3299].club_type == "National Team" and out[3299].confederation == "UEFA" and \
        out[3299].current_league_name == fixed.NOT_APPLICABLE


def test_player_and_match_incoming(spark):
    players = spark.createDataFrame([("7", None, None, "England", "Attack", None, "right", None, "185", "0",
                                      "2000-02-29", "2026-06-30 00:00:00", "B1", 1)],
                                    "player_id string, name string, country_of_birth string, "
                                    "country_of_citizenship string, position string, sub_position string, foot string, "
                                    "agent_name string, height_in_cm string, international_caps string, "
                                    "date_of_birth string, contract_expiration_date string, batch_id string, "
                                    "source_row long")
    p = WH.player_incoming(players).collect()[0]
    assert (p.full_name, p.height_band, p.international_caps_band, p.contract_expiry_year, p.date_of_birth) == \
        ("Cầu thủ 7", "180-189", "Chưa khoác áo", 2026, dt.date(2000, 2, 29))
    assert p.agent_name == fixed.UNKNOWN
    games = spark.createDataFrame([("100", "5. Matchday", None, "Ref A", None, "4-3-3", "12000", "B1", 1),
                                   ("101", None, "S", None, None, None, None, "B1", 2)],
                                  "game_id string, round string, stadium string, referee string, "
                                  "home_club_formation string, away_club_formation string, attendance string, "
                                  "batch_id string, source_row long")
    m = {r.game_id: r for r in WH.match_incoming(games).collect()}
    assert (m[100].round_type, m[100].attendance_band, m[100].stadium) == ("Matchday", "10.000-29.999", fixed.UNKNOWN)
    assert (m[101].round_type, m[101].referee, m[101].attendance_band) == (fixed.UNKNOWN, fixed.UNKNOWN,
                                                                           fixed.UNKNOWN)
