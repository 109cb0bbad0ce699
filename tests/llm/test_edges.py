"""Every registered query and every stage on odd rows, on no rows, and with extra columns of clashing names."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import decontaminate, language_id, license_scan, near_dedup, pii, queries, secret_scan

NAMES = sorted(n for n in queries.queries())
ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa alpha beta"), (2, None), (3, ""), (4, "tiny item")]


@pytest.fixture(scope="module")
def odd(folder_of, odd_rows):
    return folder_of(odd_rows, ITEMS)


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, odd_rows, name):
    got = queries.queries()[name](spark, odd).collect()
    if name.startswith("op1_"):
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(4, 1), (5, 1)}
    else:
        assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in odd_rows)


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(spark, folder_of, name):
    assert queries.queries()[name](spark, folder_of([])).count() == 0


def test_pipeline_on_odd_rows(spark, odd):
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, odd).collect()]
    assert 5 not in got and 4 not in got  # the copies of an item go
    assert got.count(6) in (1, 2)


def test_pipeline_on_no_rows(spark, folder_of):
    assert corpus_pipeline.run(spark, folder_of([])).count() == 0


def test_stages_keep_columns_and_clashing_names(spark, docs_of, folder_of):
    text = "the cat sat on the mat and looked at the old dog password=abcdef123456789 again"
    docs = docs_of([(i, f"{text} number {i} {'word ' * i}", "en") for i in range(8)])
    for c in ("score", "rejected", "lang_pred", "spans", "node", "digest", "class_id", "bands", "body", "_node", "bucket"):
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    d = folder_of([], [(1, "something else entirely that is not in any of the texts at all")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        row = out.first()
        assert row["score"] == "own score" and row["spans"] == "own spans" and row["_node"] == "own _node"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, d).count() == 8


def test_operators_replace_clashing_columns(spark, docs_of):
    docs = docs_of([(1, "hello there my friend", "en"), (2, "bonjour mon ami cher", "fr")]).withColumns({c: F.lit("x") for c in ("score", "digest", "license_id", "spans", "rejected")})
    model = language_id.fit(docs)
    assert language_id.identify(docs, model).filter("lang_pred = lang").count() == 2
    assert license_scan.scan_licenses(docs).filter("license_id is null").count() == 2
    assert secret_scan.scan_secrets(docs).filter(F.size("spans") == 0).count() == 2
    assert pii.sanitise(docs).columns == docs.columns
    assert near_dedup.keep_first(docs).columns == docs.columns
    assert decontaminate.drop_leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 2
