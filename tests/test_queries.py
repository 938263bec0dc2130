"""Each registered query of the reference's operators against its SQL twin on a small scale."""

import duckdb
import pytest

from chronoloom.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())))
    cursor = sql.execute(ORACLES[name])
    place = [[x[0] for x in cursor.description].index(c) for c in columns]
    assert len(place) == len(cursor.description)
    want = sorted(repr(tuple(plain(r[i]) for i in place)) for r in cursor.fetchall())
    assert got == want
