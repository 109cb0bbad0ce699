"""The SQL of the llm queries is text and gives the query's rows."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from leafmill.llm import queries

DATA = Path("/root/testdata/sf0.001")


def test_oracles_are_sql():
    assert all(isinstance(sql, str) for sql in queries.oracle_sql().values()) and set(queries.oracle_sql()) <= set(queries.queries())
    assert corpus_pipeline.ORACLE_SQL is None or isinstance(corpus_pipeline.ORACLE_SQL, str)


@pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    got = queries.queries()[name](spark, str(DATA))
    cols = sorted(got.columns)
    res = con.execute(queries.oracle_sql()[name])
    at = [[x[0] for x in res.description].index(c) for c in cols]
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(n for n in queries.queries() if n != "op1_decontaminate"))
def test_large_ids_beside_a_null(spark, folder_of, name):
    ids = [2**53 + 1, None, 2**62 + 3, 7]
    got = queries.queries()[name](spark, folder_of([(i, f"some words of text {i} and a few more words", "en") for i in ids])).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted(ids, key=repr)


def test_large_ids_beside_a_null_in_hits(spark, folder_of):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    d = folder_of([(2**53 + 1, item, "en"), (None, item, "en")], [(2**53 + 3, item)])
    got = queries.queries()["op1_decontaminate"](spark, d).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=repr) == sorted([(2**53 + 1, 2**53 + 3), (None, 2**53 + 3)], key=repr)
