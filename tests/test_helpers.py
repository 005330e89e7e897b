"""Small operators and column functions that no query calls by themselves."""
import datetime as dt

from pyspark.sql import functions as F

from kickstar import fixed
from kickstar.functions import exprs as X
from kickstar.operators import agg as A
from kickstar.operators import dedup as D
from kickstar.operators import joins as J
from kickstar.operators import keys as K
from kickstar.operators import windows as W
from kickstar.plans import cube as C
from kickstar.plans import warehouse as WH
from kickstar.sources import driver, staging
from tests.conftest import SF_SMALL, rows


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_joins(spark):
    fact = spark.createDataFrame([(1, 10, 5), (2, 11, 7), (3, 99, 9)], "a int, b int, v int")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "a int, name string")
    b = spark.createDataFrame([(10, "p"), (11, "q")], "b int, kind string")
    assert rows(J.star_join(fact, (a, "a"), (b, ["b"])).select("name", "kind", "v")) == [("x", "p", 5), ("y", "q", 7)]
    assert rows(J.role_join(fact, a.withColumnRenamed("a", "k"), "k", "a", "home_", ["name"], "left").select("v", "home_name")) == [(5, "x"), (7, "y"), (9, None)]
    assert rows(J.semi_join(fact, b, "b").select("v")) == [(5,), (7,)]
    assert rows(J.values_join(fact, b, "b").select("v", "kind")) == [(5, "p"), (7, "q"), (9, None)]
    assert rows(J.key_filter(b, F.col("kind") == "q", "b")) == [(11,)]
    twice = spark.createDataFrame([("u", 1), ("u", 4), ("w", 2)], "nat string, sk int")
    src = spark.createDataFrame([("u",), ("z",), (None,)], "code string")
    assert rows(J.lookup_key(src, twice, "code", "nat", "sk")) == [("u", 4), ("z", None), (None, None)]
    hit, new = J.lookup_match_split(fact, a, "a")
    assert rows(hit.select("a", "old_name")) == [(1, "x"), (2, "y")] and rows(new) == [(3, 99, 9)]


def test_aggregates(spark):
    df = spark.createDataFrame([("x", "r", 1), ("x", None, 2), ("y", "r", 4)], "g string, c string, v int")
    assert rows(A.group_agg(df, ["g"], {"s": F.sum("v"), "n": F.count(F.lit(1))})) == [("x", 3, 2), ("y", 4, 1)]
    total = df.rollup("c").agg(A.labelled_total("c", "All").alias("label"), F.sum("v").alias("s")).select("label", "s")
    assert rows(total) == sorted([("r", 5), (None, 2), ("All", 7)], key=repr)
    assert rows(A.pivot_sum(df, ["g"], "c", ["r", "t"], "v")) == [("x", 1, None), ("y", 4, None)]
    assert rows(W.member_spine(spark.createDataFrame([("m", 2), ("m", 5), ("n", 3)], "m string, s int"), ["m"], "s")) == [
        ("m", 2), ("m", 3), ("m", 4), ("m", 5), ("n", 3)]
    assert df.agg(K.next_key_base(df, "v")).first()[0] == 4


def test_sets_and_members(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "k int, v string")
    assert rows(D.dedup_identical(df, ["k"])) == [(1, "a"), (2, "b"), (3, None)]
    assert rows(D.select_distinct(df, ["v"])) == sorted([("a",), ("b",), (None,)], key=repr)
    assert rows(D.except_values(df, "v", ["a"])) == [(2, "b"), (3, None)]
    assert rows(C.custom_group_member(df, F.when(F.col("k") < 2, "low").otherwise("high"), "part").groupBy("part").count()) == [("high", 2), ("low", 2)]


def test_column_functions(spark):
    day = F.lit(dt.date(2024, 7, 1))
    assert one(spark, X.safe_numeric(F.lit("1.5")), X.safe_numeric(F.lit("x")), X.scale_millions(F.lit(2_500_000))) == (1.5, None, 2.5)
    assert one(spark, *[X.fee_band_order(F.lit(b)) for b in (*fixed.FEE_BANDS, fixed.FEE_BAND_NA, "?")]) == (*range(1, len(fixed.FEE_BANDS) + 1), 0, 9)
    assert one(spark, X.date_key_or_unknown(day), X.date_key_or_unknown(F.lit(None).cast("date"))) == (20240701, -1)
    assert one(spark, X.age_days365(F.lit(dt.date(2004, 7, 1)), day)) == (20,)
    assert one(spark, X.flag_not_null(F.lit(0)), X.flag_not_null(F.lit(None).cast("int")), X.is_free_or_loan(F.lit(0)), X.is_free_or_loan(F.lit(None).cast("long"))) == (1, 0, 1, 0)
    assert one(spark, X.pro_count(F.lit(0)), X.pro_count(F.lit(1)), X.pro_age(F.lit(25), F.lit(0)), X.pro_age(F.lit(17), F.lit(1))) == (1, 0, 25, 0)
    assert one(spark, X.safe_ratio(F.lit(3), F.lit(4), 100.0), X.safe_ratio(F.lit(3), F.lit(0)), X.safe_ratio(F.lit(None).cast("int"), F.lit(2))) == (75.0, None, None)
    assert one(spark, staging.batch_id_col(F.lit(dt.datetime(2024, 7, 1, 9, 5, 3)))) == ("BATCH_20240701_090503",)
    labels = WH.dim_labels(spark.range(1).select(day.alias("full_date"))).first()
    assert labels.date_label == "01/07/2024" and labels.month_label and labels.quarter_label


def test_views(spark):
    driver.register_views(spark, SF_SMALL, ["nation"])
    assert spark.sql("SELECT count(*) FROM nation").first()[0] == 25
