"""Join, cube and KPI operator fixtures."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from kickstar.operators import agg as A
from kickstar.operators import joins as J
from kickstar.operators import keys as K
from kickstar.operators import windows as W
from kickstar.plans import cube
from kickstar.plans import kpi as KP
from tests.conftest import rows


def test_or_join_self_transfer(spark):
    ft = spark.createDataFrame([(1, 1, 100), (1, 2, 50)], "to_club long, from_club long, fee long")
    roles = J.unpivot_roles(ft, {"to": "to_club", "from": "from_club"}, ["fee"])
    g = roles.groupBy("club_key").agg(A.conditional_sum(F.col("role") == "to", F.col("fee")).alias("spend"),
                                      A.conditional_sum(F.col("role") == "from", F.col("fee")).alias("income"))
    assert rows(g) == [(1, 150, 100), (2, 0, 50)]     # self transfer: once as buyer, once as seller


def test_lookup_and_unknown_key(spark):
    df = spark.createDataFrame([("GB1",), ("XX",)], "code string")
    dim = spark.createDataFrame([(1, "GB1"), (2, "ES1")], "competition_key int, competition_id string")
    out = J.unknown_key(J.lookup_key(df, dim, "code", "competition_id", "competition_key"), "competition_key")
    assert rows(out) == [("GB1", 1), ("XX", -1)]


def test_lookup_match_split(spark):
    df = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "old")], "k int, v string")
    m, n = J.lookup_match_split(df, dim, "k")
    assert rows(m) == [(1, "a", "old")] and rows(n) == [(3, "c")]


def test_full_outer_role_merge(spark):
    a = spark.createDataFrame([(1, 10)], "k int, spent int")
    b = spark.createDataFrame([(2, 5)], "k int, income int")
    out = J.full_outer_role_merge(a, b, ["k"], {"spent": 0, "income": 0})
    assert rows(out, "k", "spent", "income") == [(1, 10, 0), (2, 0, 5)]


def test_asof_version_join(spark):
    dim = spark.createDataFrame([(1, 10, dt.date(1900, 1, 1), dt.date(2019, 12, 31)),
                                 (2, 10, dt.date(2020, 1, 1), dt.date(9999, 12, 31))],
                                "club_key long, club_id long, effective_date date, expiry_date date")
    f = spark.createDataFrame([(1, 10, dt.date(2018, 5, 1)), (2, 10, dt.date(2021, 5, 1)), (3, 99, dt.date(2021, 1, 1))],
                              "rid int, club_id long, d date")
    out = J.asof_version_join(f, dim, "club_id", "d", "club_key")
    assert rows(out, "rid", "club_key") == [(1, 1), (2, 2), (3, -1)]
    # overlapping versions: the latest start wins where they overlap, nested ends respected
    odim = spark.createDataFrame([(1, 7, dt.date(1900, 1, 1), dt.date(1995, 12, 31)),
                                  (2, 7, dt.date(1990, 1, 1), dt.date(2000, 12, 31)),
                                  (3, 7, dt.date(1980, 1, 1), dt.date(2020, 12, 31))],
                                 "club_key long, club_id long, effective_date date, expiry_date date")
    g = spark.createDataFrame([(i, 7, dt.date(y, 6, 1)) for i, y in enumerate([1970, 1985, 1993, 2010, 2030])],
                              "rid int, club_id long, d date")
    got = rows(J.asof_version_join(g, odim, "club_id", "d", "club_key"), "rid", "club_key")
    assert got == [(0, 1), (1, 3), (2, 2), (3, 3), (4, -1)]


def test_last_non_empty_vs_squad_value(spark):
    df = spark.createDataFrame([(1, "p1", dt.date(2024, 1, 1), 10), (1, "p1", dt.date(2024, 3, 1), 30),
                                (1, "p2", dt.date(2024, 2, 1), 20)], "club int, player string, d date, v long")
    lne = A.last_non_empty(df, ["club"], "d", "v", "mv")
    sq = A.squad_value(df, ["club"], "player", "d", "v", "sq")
    assert rows(lne) == [(1, 30)]          # only the rows on the last date with data
    assert rows(sq) == [(1, 50)]           # each player's last value


def test_prev_member_vs_lag(spark):
    df = spark.createDataFrame([(1, 2018, 5), (1, 2020, 7)], "m int, season int, goals int")
    n = cube.neighbours(df, ["m"], "season", "goals", "prev", "next")
    assert rows(n, "season", "prev", "next") == [(2018, None, None), (2020, None, None)]   # 2019 is a gap
    lag = W.running(df, ["m"], ["season"], "goals", "run")
    assert rows(lag, "season", "run") == [(2018, 5), (2020, 12)]
    avg = cube.last_periods_avg(df, ["m"], "season", "goals", 3, "avg3")
    assert rows(avg, "season", "avg3") == [(2018, 5.0), (2020, 6.0)]


def test_grouping_flags_real_null(spark):
    df = spark.createDataFrame([("UEFA", None, 1), ("UEFA", "ENG", 2)], "conf string, country string, n int")
    r = df.rollup("conf", "country").agg(F.grouping_id().alias("g"), F.sum("n").alias("n"))
    got = rows(r, "conf", "country", "g", "n")
    assert (None, None, 3, 3) in got and ("UEFA", None, 0, 1) in got and ("UEFA", None, 1, 3) in got


def test_kpi_status_and_trend(spark):
    df = spark.createDataFrame([(1, 2020, 0.39), (1, 2021, 0.4), (1, 2022, 0.5), (2, 2021, 0.41)],
                               "m int, season_key int, win_rate double")
    out = KP.evaluate_kpi(df, "kpi_manager_win_rate", ["m"])
    got = rows(out, "m", "season_key", "kpi_status", "kpi_trend")
    assert got == [(1, 2020, -1, 0), (1, 2021, 0, 1), (1, 2022, 1, 1), (2, 2021, 0, 0)]
    fp = spark.createDataFrame([(1, 2020, 3.0), (1, 2021, 4.0), (1, 2022, 4.01)], "m int, season_key int, "
                               "cards_per_match double")
    got = rows(KP.evaluate_kpi(fp, "kpi_club_fair_play", ["m"]), "season_key", "kpi_status", "kpi_trend")
    assert got == [(2020, 1, 0), (2021, 0, -1), (2022, -1, -1)]     # inverted trend: rising cards is -1


def test_global_positions_and_ntile(spark):
    df = spark.range(0, 103).select((F.col("id") * 7 % 103).alias("v"), F.col("id"))
    pos = K.global_positions(df, [F.desc("v"), F.asc("id")], "pos", partitions=5)
    got = sorted((r.pos, r.v) for r in pos.collect())
    assert [p for p, _ in got] == list(range(1, 104))
    assert [v for _, v in got] == sorted((r.v for r in df.collect()), reverse=True)
    nt = W.with_ntile(df, [F.desc("v"), F.asc("id")], 4, "q")
    sizes = sorted(((r.q, c) for r, c in [(r, 1) for r in nt.collect()]))
    counts = {}
    for q, _ in sizes:
        counts[q] = counts.get(q, 0) + 1
    assert counts == {1: 26, 2: 26, 3: 26, 4: 25}


def test_slice_dice_except(spark):
    df = spark.createDataFrame([("2024/25", "GB1", "Attack", 1), ("2024/25", "ES1", "Defender", 2),
                                ("2023/24", "GB1", None, 3)], "season string, comp string, pos string, n int")
    assert rows(cube.cube_slice(df, season="2024/25"), "n") == [(1,), (2,)]
    assert rows(cube.cube_dice(df, {"comp": ["GB1"], "season": ["2023/24", "2024/25"]}), "n") == [(1,), (3,)]
    assert rows(cube.except_members(df, "pos", ["Defender"]), "n") == [(1,), (3,)]   # NULL member kept


def test_scd1_only_merge(spark):
    from kickstar.plans import warehouse as WH
    spec = WH.ScdSpec(natural_key="competition_id", surrogate="competition_key",
                      scd1=("competition_name", "country_name"))
    dim = spark.createDataFrame([(-1, "-1", "unknown", "u", dt.date(1900, 1, 1), dt.date(9999, 12, 31), True),
                                 (1, "GB1", "Premier", "England", dt.date(1900, 1, 1), dt.date(9999, 12, 31), True)],
                                "competition_key long, competition_id string, competition_name string, "
                                "country_name string, effective_date date, expiry_date date, is_current boolean")
    inc = spark.createDataFrame([("GB1", "Premier League", "England"), ("ES1", "LaLiga", "Spain")],
                                "competition_id string, competition_name string, country_name string")
    out = rows(WH.scd_merge(dim, inc, spec, "2024-07-01"), "competition_key", "competition_id", "competition_name")
    assert out == [(-1, "-1", "unknown"), (1, "GB1", "Premier League"), (2, "ES1", "LaLiga")]


def test_global_rank_matches_window_rank(spark):
    # a hot tuple (v=5, w=1) holds a third of the rows; NULLs in both keys
    hot = spark.range(0, 60).select(F.lit(5).alias("v"), F.lit(1).alias("w"), F.col("id"))
    rest = spark.range(60, 180).select(
        F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.col("id") % 11).cast("int").alias("v"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("id") % 3).cast("int").alias("w"), F.col("id"))
    df = hot.unionByName(rest)
    order = Window.orderBy(F.col("v").desc(), F.col("w").asc())
    want = sorted((r.id, r.r, r.d) for r in df.select(
        "id", F.rank().over(order).alias("r"), F.dense_rank().over(order).alias("d")).collect())
    got_r = K.global_rank(df, ["v", "w"], "r", ascending=[False, True], partitions=4)
    got = K.global_rank(got_r, ["v", "w"], "d", ascending=[False, True], dense=True, partitions=3)
    assert sorted((r.id, r.r, r.d) for r in got.collect()) == want


def test_rank_in_set(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 3), ("d", 1)], "m string, x int")
    out = cube.rank_in_set(df, "x", "rk", "pos", ["m"])
    assert rows(out, "m", "rk", "pos") == [("a", 2, 2), ("b", 1, 1), ("c", 2, 3), ("d", 4, 4)]


def test_stored_reuses_finished_copy_by_fingerprint(spark):
    import uuid
    from kickstar.frames import stored
    fp = uuid.uuid4().hex[:12]
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    a = stored(df, "t_store", fp, ["p"])
    b = stored(spark.range(3).withColumn("p", F.lit(0)), "t_store", fp, ["p"])   # same fingerprint: reused
    assert sorted(a.inputFiles()) == sorted(b.inputFiles()) and b.count() == 10
    assert a.columns == ["id", "p"]
    c = stored(df, "t_store", fp, ["p"], reuse=False)                           # private fresh copy
    assert not set(c.inputFiles()) & set(a.inputFiles()) and c.count() == 10
