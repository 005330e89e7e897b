"""Shuffles begin with partitions in number to the input, so none grows with it."""
from kickstar import registry, session
from kickstar.sources.driver import input_bytes
from tests.conftest import SF_SMALL

KEY = session.INITIAL_PARTITIONS


def test_partitions_grow_with_the_input():
    assert session.partitions_for(0, 12) == 12 and session.partitions_for(3 << 20, 12) == 12
    assert session.partitions_for(700 << 20, 12) == 350 and session.partitions_for(4200 << 20, 200) == 2100


def test_query_sets_them_and_a_given_number_stays(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "3")
    assert input_bytes(own, SF_SMALL) > 0 and input_bytes(own, "/nowhere") == 0
    registry.queries()["q_gen_dim_date"](own, SF_SMALL)
    assert own.conf.get(KEY) == str(session.partitions_for(input_bytes(own, SF_SMALL), 3))
    session.size_shuffles(own, 100 << 20)                   # the next query's input
    assert own.conf.get(KEY) == "50"
    own.conf.set(KEY, "7")
    session.size_shuffles(own, 900 << 20)
    assert own.conf.get(KEY) == "7"
