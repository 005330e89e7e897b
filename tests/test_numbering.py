"""Global numbering on more rows than range sampling reads, with payload columns and several
files; the optimizer's reuse of exchanges must not matter."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kickstar.operators import keys as K
from kickstar.operators import windows as W

N = 400_000


@pytest.fixture(scope="module", params=["true", "false"])
def big(spark, request, tmp_path_factory):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    path = str(tmp_path_factory.mktemp("rows"))
    (spark.range(N).select(F.xxhash64("id").alias("v"), (F.xxhash64("id") % 1000).alias("g"), "id", F.md5(F.col("id").cast("string")).alias("payload"))
     .repartition(7).write.mode("overwrite").parquet(path))
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.exchange.reuse", "true")


def test_positions_equal_a_window(big):
    got = K.global_positions(big, ["v", "id"], "pos")
    want = big.withColumn("want", F.row_number().over(Window.orderBy("v", "id"))).select("id", "want")
    assert got.join(want, "id").filter("pos = want").count() == N
    assert got.select("pos").distinct().count() == N and got.agg(F.max("pos")).first()[0] == N


def test_ntile_equals_a_window(big):
    got = W.with_ntile(big, ["v", "id"], 7, "q")
    want = big.withColumn("want", F.ntile(7).over(Window.orderBy("v", "id"))).select("id", "want")
    assert got.join(want, "id").filter("q = want").count() == N


def test_ranks_equal_a_window(big):
    for dense, fn in ((False, F.rank), (True, F.dense_rank)):
        got = K.global_rank(big.select("id", "g"), ["g"], "r", dense=dense)
        want = big.withColumn("want", fn().over(Window.orderBy("g"))).select("id", "want")
        assert got.join(want, "id").filter("r = want").count() == N


def test_surrogate_keys_are_unique(big):
    keys = K.surrogate_key(big, ["v", "id"], "k", 10)
    assert keys.select("k").distinct().count() == N and keys.agg(F.min("k"), F.max("k")).first() == (11, N + 10)
