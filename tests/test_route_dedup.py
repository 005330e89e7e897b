"""Reject routing and de-duplication fixtures."""
from pyspark.sql import functions as F

from kickstar.operators import dedup as D
from kickstar.operators import route as R


def test_cast_or_reject(spark):
    df = spark.createDataFrame([("1", "x"), ("2", ""), ("3", "4"), ("4", None)], "k string, own_goals string")
    df = df.withColumn("own_goals", F.nullif(F.col("own_goals"), F.lit("")))
    ok, bad = R.cast_or_reject(df, {"own_goals": "int"})
    assert sorted(r.k for r in bad.collect()) == ["1"]            # 'x' does not cast
    assert sorted(r.k for r in ok.collect()) == ["2", "3", "4"]   # '' became NULL: continues (rule decides)
    valid, rej = R.validate_or_reject(ok, [(F.col("c_own_goals").isNull(), "goals missing")])
    assert sorted(r.k for r in rej.collect()) == ["2", "4"]
    assert [r.k for r in valid.collect()] == ["3"]


def test_validate_or_reject_ordered_and_window(spark):
    rows = [(1, -1, 0, "2020-01-01"), (2, 0, 0, "2020-01-01"), (3, 130, 0, "2020-01-01"),
            (4, 131, 0, "2020-01-01"), (5, 10, -1, "2020-01-01"), (None, 10, 0, "2020-01-01"),
            (7, 10, 0, "2010-01-01")]
    df = spark.createDataFrame(rows, "game_id int, minutes int, goals int, d string") \
        .withColumn("d", F.to_date("d"))
    rules = [(F.col("game_id").isNull(), "game missing"),
             ((F.col("minutes") < 0) | (F.col("minutes") > 130), "minutes out of range"),
             (F.col("goals") < 0, "negative goals")]
    valid, rej = R.validate_or_reject(df, rules, R.load_window_filter(F.col("d"), "2015-01-01", "2025-12-31"))
    assert sorted(r.game_id for r in valid.collect()) == [2, 3]
    got = sorted(((r.game_id or 0), r[R.REASON]) for r in rej.collect())
    assert got == [(0, "game missing"), (1, "minutes out of range"), (4, "minutes out of range"),
                   (5, "negative goals")]            # row 7: outside the window, silently skipped


def test_dedup_latest_batch(spark):
    df = spark.createDataFrame([("p1", "2024-01-01", "BATCH_1", 1, 100), ("p1", "2024-01-01", "BATCH_2", 2, 200),
                                ("p2", "2024-01-01", "BATCH_1", 3, 5)], "k string, d string, b string, r int, v int")
    out = {r.k: r.v for r in D.dedup_latest(df, ["k", "d"], ["b", "r"]).collect()}
    assert out == {"p1": 200, "p2": 5}


def test_dedup_latest_carries_each_column_once(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "b", 1, "y"), (1, None, 2, None), (None, "c", 1, "z")], "k int, v string, r int, w string")
    out = D.dedup_latest(df, ["k"], ["r", "v"])
    assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=repr) == sorted([(1, None, 2, None), (None, "c", 1, "z")], key=repr)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and "__ord" not in plan


def test_one_distinct_measure_of_the_fact_is_counted_once(spark):
    from pyspark.sql import functions as F

    from kickstar.plans import measures as M
    fact = spark.createDataFrame([(1, 5, 1, 0), (1, 5, 0, 1), (1, None, 1, 0), (2, 6, 0, 0), (None, 6, 1, 1)], "club_key int, match_key long, yellow_cards int, red_cards int")
    got = M.evaluate(fact, ["club_key"], ["cards_per_match"])
    want = fact.groupBy("club_key").agg(F.count_distinct("match_key").alias("n"))
    assert {r.club_key: r.m_distinct_matches for r in got.collect()} == {r.club_key: r.n for r in want.collect()}
    assert "distinct" not in got._jdf.queryExecution().analyzed().toString().lower().replace("m_distinct_matches", "")
