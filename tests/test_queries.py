"""Every registered query of the change-log library against its SQL, on the smallest tables."""

import math
from pathlib import Path

import pytest

from vecflow.plans import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are absent")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query(spark, duck, key):
    df = registry.queries()[key](spark, str(DATA))
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    cur = duck.execute(registry.oracle_sql()[key])
    own = [d[0] for d in cur.description]
    assert sorted(own) == names
    want = sorted((tuple(plain(r[own.index(c)]) for c in names) for r in cur.fetchall()), key=repr)
    assert got == want
