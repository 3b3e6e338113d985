"""Every registered query runs on the smallest tables, and those with SQL give its rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from stepquarry.plans import catalogue
from stepquarry.plans.registry import QUERIES, SQL


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    df = QUERIES[name](spark, small)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in SQL:
        r = con.execute(SQL[name])
        names = [x[0] for x in r.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == Counter(tuple(plain(x[i]) for i in at) for x in r.fetchall())


def test_flagship():
    assert catalogue.FLAGSHIP in QUERIES
