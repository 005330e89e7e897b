"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import math

import duckdb
import pytest

from kickstar import oracle, registry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def test_every_query_has_oracle():
    assert set(oracle.SQL) == set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = registry.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    cur = con.execute(oracle.SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    cols = sorted(dcols)
    assert _rows(srows, cols) == _rows(drows, cols)
