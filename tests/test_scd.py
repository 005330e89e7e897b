"""SCD 1/2/3 merge fixtures (FIXTURES.md §2: scd123_merge_club, scd12_merge_player)."""
import datetime as dt

from kickstar.plans import warehouse as WH
from kickstar.plans.staged import CLUB_DIM_SCHEMA

OPEN, FIRST = dt.date(9999, 12, 31), dt.date(1900, 1, 1)


def club(key, cid, name, league_id, league_name, stadium, prev=None, eff=FIRST, exp=OPEN, cur=True):
    return (key, cid, name, "Club", "X", "UEFA", league_id, league_name, prev, stadium, "B", eff, exp, cur)


def inc(cid, name, league_id, league_name, stadium):
    return (cid, name, "Club", "X", "UEFA", league_id, league_name, stadium, "B")


INC_SCHEMA = ("club_id long, club_name string, club_type string, country_name string, confederation string, "
              "current_league_id string, current_league_name string, stadium_name string, "
              "stadium_capacity_band string")


def test_club_merge(spark):
    dim = spark.createDataFrame([
        club(-1, -1, "unknown", None, "u", "u"),
        club(1, 10, "A", "L1", "League 1", "S1"),
        club(2, 20, "B", "L1", "League 1", "S0", eff=FIRST, exp=dt.date(2019, 12, 31), cur=False),
        club(3, 20, "B", "L1", "League 1", "S2", eff=dt.date(2020, 1, 1)),
        club(4, 30, "C", "L1", "League 1", "S3"),
        club(5, 40, "D", "L1", "League 1", "S4"),
        club(6, 50, "E", "L1", "League 1", "S5"),
        club(7, 60, "F", "L1", "League 1", "S6"),
    ], CLUB_DIM_SCHEMA)
    incoming = spark.createDataFrame([
        inc(10, "A", "L1", "League 1", "S1"),          # unchanged
        inc(20, "B2", "L1", "League 1", "S2"),         # name only -> overwrite every version
        inc(30, "C", "L1", "League 1", "S3new"),       # stadium only -> new version
        inc(40, "D", "L2", "League 2", "S4"),          # league only -> shift previous league
        inc(50, "E", "L2", "League 2", "S5new"),       # stadium + league -> new version, shifted league
        inc(60, "F2", "L2", "League 2", "S6"),         # league + name -> SCD3 only, name waits
        inc(70, "G", "L1", "League 1", "S7"),          # new member
    ], INC_SCHEMA)
    out = {r.club_key: r for r in WH.scd_merge(dim, incoming, WH.CLUB_SPEC, "2024-07-01").collect()}
    assert len(out) == 11
    assert out[-1].club_name == "unknown"
    assert out[1].club_name == "A" and out[1].is_current
    assert out[2].club_name == "B2" and out[3].club_name == "B2"          # all versions
    assert not out[4].is_current and out[4].expiry_date == dt.date(2024, 6, 30)
    assert out[8].club_id == 30 and out[8].stadium_name == "S3new" and out[8].effective_date == dt.date(2024, 7, 1)
    assert out[5].current_league_id == "L2" and out[5].previous_league_name == "League 1" and out[5].is_current
    assert not out[6].is_current
    assert (out[9].club_id, out[9].current_league_id, out[9].previous_league_name, out[9].stadium_name) == \
        (50, "L2", "League 1", "S5new")
    assert (out[7].club_name, out[7].current_league_id, out[7].previous_league_name) == ("F", "L2", "League 1")
    assert out[10].club_id == 70 and out[10].effective_date == FIRST and out[10].is_current
    # every member has exactly one current version
    cur = [r.club_id for r in out.values() if r.is_current]
    assert len(cur) == len(set(cur))


PLAYER_SCHEMA = ("player_key long, player_id long, full_name string, date_of_birth date, country_of_birth string, "
                 "citizenship string, position string, sub_position string, foot string, height_band string, "
                 "agent_name string, contract_expiry_year int, international_caps_band string, "
                 "effective_date date, expiry_date date, is_current boolean")


def player(key, pid, agent, caps):
    return (key, pid, f"P{pid}", dt.date(2000, 1, 1), "X", "X", "Attack", "CF", "right", "180-189", agent, 2026,
            caps, FIRST, OPEN, True)


def test_player_merge(spark):
    dim = spark.createDataFrame([player(1, 1, "ag", "1-10"), player(2, 2, "ag", "1-10"),
                                 player(3, 3, "ag", "1-10")], PLAYER_SCHEMA)
    inc_rows = [r[1:13] for r in [player(0, 1, "ag2", "1-10"), player(0, 2, "ag", "11-50"),
                                  player(0, 3, "ag3", "11-50")]]
    incoming = spark.createDataFrame(inc_rows, PLAYER_SCHEMA.split(", effective_date")[0].split(", ", 1)[1])
    out = {r.player_key: r for r in WH.scd_merge(dim, incoming, WH.PLAYER_SPEC, "2024-07-01").collect()}
    assert not out[1].is_current and out[4].agent_name == "ag2" and out[4].player_id == 1      # agent -> version
    assert out[2].is_current and out[2].international_caps_band == "11-50"                       # caps -> overwrite
    assert not out[3].is_current and out[3].international_caps_band == "1-10"                    # old keeps old
    assert (out[5].agent_name, out[5].international_caps_band) == ("ag3", "11-50")               # both carried
