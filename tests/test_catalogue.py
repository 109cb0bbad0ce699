import math
from pathlib import Path

import duckdb
import pytest

from leafmill.plans import catalogue, catalogue_models, catalogue_more, catalogue_reports  # noqa: F401  the other modules add to the first

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


def plain(v):
    return round(float(v), 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)
    if name in catalogue.SQL:
        res = duck.execute(catalogue.SQL[name])
        at = [[x[0] for x in res.description].index(c) for c in cols]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=repr)
    else:
        assert got
