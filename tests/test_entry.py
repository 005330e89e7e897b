import __spark_entry__ as E
from kickstar import registry


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:2] == ["club_name", "matches"]


def test_registry_names():
    names = set(registry.queries())
    assert names <= set(E.queries()) and all(n.startswith("q_") for n in names)
    assert len(names) >= 85
    assert set(E.oracle_sql()) <= set(E.queries())
