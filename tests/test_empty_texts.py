"""Queries that divide by a size, over texts of no characters: the rows of their SQL."""

import duckdb
import pytest

from leafmill.plans import catalogue, catalogue_reports  # noqa: F401  the second adds to the first


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts = ["", "", "the first\nline", "\n\n", "x" * 4000, "the " * 3000, "a\nb\nc", "", "word " * 40 + "\nthe end", "the"]
    d = tmp_path_factory.mktemp("empty")
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(50, "", "en", "s", 0), (52, "the second\nline", "en", "s", 15), (53, "the\nother", "en", "s", 9), (54, None, "en", "s", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").filter("doc_id <> 54").write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(d / "null" / "documents.parquet"))
    return d


def both(spark, d, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, str(d))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalogue.SQL[name]})").fetchall()
    return sorted(map(tuple, df.collect()), key=repr), sorted(want, key=repr)


def test_cluster_representative_with_empty_texts(spark, folder):
    got, want = both(spark, folder, "cluster_representative")
    assert got == want and (0, 2, 0, False) in got


def test_cluster_representative_leaves_out_null_texts(spark, folder):
    got, want = both(spark, folder / "null", "cluster_representative")
    assert got == want and (4, 1, 4, False) in got


def test_prefilter_gated_rules_with_empty_texts(spark, folder):
    got, want = both(spark, folder, "prefilter_gated_rules")
    assert got == want and (0, "tiny", "tiny", "phrase") in got


def test_prefilter_report_with_empty_texts(spark, folder):
    got, want = both(spark, folder, "prefilter_report")
    assert got == want and len(got) == 3
