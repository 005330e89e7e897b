"""Column functions against the fixture rows of FIXTURES.md §2."""
import datetime as dt

from pyspark.sql import functions as F

from kickstar import fixed
from kickstar.functions import exprs as X


def one_col(spark, values, dtype, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_text(spark):
    assert one_col(spark, ["  A  ", "  ", None, " B "], "string", X.clean_text) == ["A", None, None, "B"]


def test_clean_text_null_tokens(spark):
    assert one_col(spark, ["nan", "None", "null", "NULL", "x"], "string", X.clean_text_null_tokens) == \
        [None, None, None, None, "x"]


def test_clean_date_text(spark):
    assert one_col(spark, ["2024-05-01 00:00:00", " ", None], "string", X.clean_date_text) == \
        ["2024-05-01", None, None]


def test_fold_ligatures(spark):
    assert one_col(spark, ["Solskjær", "Großkreutz", "Œuvre"], "string", X.fold_ligatures) == \
        ["Solskjaer", "Grosskreutz", "Oeuvre"]


def test_sentinel_to_null(spark):
    assert one_col(spark, ["-1", " 3 ", ""], "string", X.sentinel_to_null) == [None, "3", None]


def test_remap_codes(spark):
    assert one_col(spark, ["515", "123", "2113", "2077", "75", "10"], "string", X.remap_club_code) == \
        ["-2", "-2", "-2", "-2", "-1", "10"]
    assert one_col(spark, ["", " ", "GB1", None], "string", X.blank_to_code) == ["-2", "-2", "GB1", "-2"]


def test_match_outcome(spark):
    df = spark.createDataFrame([(2, 1), (1, 1), (0, 3), (0, 0)], "gf int, ga int")
    out = df.select(*[c.alias(n) for n, c in X.match_outcome(F.col("gf"), F.col("ga")).items()]).collect()
    got = [(r.is_win, r.is_draw, r.is_loss, r.points, r.is_clean_sheet, r.goal_difference) for r in out]
    assert got == [(1, 0, 0, 3, 0, 1), (0, 1, 0, 1, 0, 0), (0, 0, 1, 0, 0, -3), (0, 1, 0, 1, 1, 0)]


def test_age_calendar_and_youth(spark):
    df = spark.createDataFrame(
        [(dt.date(2000, 2, 29), dt.date(2018, 2, 28)), (dt.date(2000, 2, 29), dt.date(2018, 3, 1)),
         (dt.date(2005, 1, 1), dt.date(2018, 6, 1)), (None, dt.date(2018, 1, 1))], "b date, d date")
    out = df.select(X.calendar_age("b", "d").alias("a"), X.age_in_range("b", "d", 14, 100).alias("v"),
                    X.youth_flag("b", "d").alias("y")).collect()
    assert [(r.a, r.v, r.y) for r in out] == [(17, 17, 1), (18, 18, 0), (13, None, 1), (None, None, None)]


def test_fee_status_band(spark):
    fees = [None, 0, 999_999, 1_000_000, 10_000_000, 10_000_001, 50_000_000, 50_000_001]
    st = one_col(spark, fees, "bigint", X.fee_status)
    bd = one_col(spark, fees, "bigint", X.fee_band)
    key = one_col(spark, fees, "bigint", X.transfer_type_key)
    assert st == [fixed.FEE_UNDISCLOSED, fixed.FEE_FREE] + [fixed.FEE_PAID] * 6
    b = fixed.FEE_BANDS
    assert bd == [fixed.FEE_BAND_NA, fixed.FEE_BAND_NA, b[0], b[1], b[1], b[2], b[2], b[3]]
    assert key == [1, 2, 3, 4, 4, 5, 5, 6]


def test_height_band(spark):
    out = one_col(spark, [149, 150, 169, 170, 180, 190, 220, 221, None], "int", X.height_band)
    u, h = fixed.UNKNOWN, fixed.HEIGHT_BANDS
    assert out == [u, h[0], h[0], h[1], h[2], h[3], h[3], u, u]


def test_stadium_attendance_caps(spark):
    s = fixed.STADIUM_BANDS
    assert one_col(spark, [0, 19999, 20000, 40000, 60000], "int", X.stadium_band) == [fixed.UNKNOWN] + list(s)
    a = fixed.ATTENDANCE_BANDS
    assert one_col(spark, [9999, 10000, 30000, 60000, None], "int", X.attendance_band) == list(a) + [fixed.UNKNOWN]
    c = fixed.CAPS_BANDS
    assert one_col(spark, [0, 10, 11, 51, None], "int", X.caps_band) == [c[0], c[1], c[2], c[3], fixed.UNKNOWN]


def test_round_type(spark):
    out = one_col(spark, ["5. Matchday", "Group A", "Final", "Semi-Finals 1st leg", None], "string", X.round_type)
    assert out == ["Matchday", "Group stage", "Final", "Knockout", fixed.UNKNOWN]


def test_normalize_confederation(spark):
    out = one_col(spark, ["europa", "ASIEN", "CONMEBOL", "xyz", None], "string", X.normalize_confederation)
    assert out == ["UEFA", "AFC", "Americas", fixed.UNKNOWN, fixed.UNKNOWN]


def test_season_labels_and_date_key(spark):
    assert one_col(spark, [2024, 1999], "int", X.season_label) == ["2024/25", "1999/00"]
    assert one_col(spark, [2024, 1999], "int", X.season_short) == ["24/25", "99/00"]
    assert one_col(spark, [dt.date(2024, 3, 5)], "date", X.date_key) == [20240305]


def test_age_groups(spark):
    df = spark.createDataFrame([(v,) for v in [None, 0, 17, 18, 21, 22, 25, 29, 32]], "a int")
    label, order = X.age_group6(F.col("a"))
    got = [(r[0], r[1]) for r in df.select(label, order).collect()]
    assert [g[1] for g in got] == [9, 9, 1, 2, 2, 3, 4, 5, 6]
    assert one_col(spark, [20, 21, 25, 26, 29, 30, None], "int", X.age_bracket4) == \
        [fixed.AGE_BRACKETS[0], fixed.AGE_BRACKETS[1], fixed.AGE_BRACKETS[1], fixed.AGE_BRACKETS[2],
         fixed.AGE_BRACKETS[2], fixed.AGE_BRACKETS[3], fixed.UNKNOWN]
