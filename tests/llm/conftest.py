import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000).strip()


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def folder_of(spark, tmp_path_factory, docs_of):
    """A folder with documents.parquet (and benchmark.parquet) for the registered queries."""

    def make(rows, items=()):
        d = tmp_path_factory.mktemp("sf")
        docs_of(rows).write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame(list(items), "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
        return str(d)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank and very long texts, copies, repeated rows, a null id."""
    return [(1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, LONG, "en"), (5, LONG, "en"), (6, "one two", "en"), (6, "one two", "en"), (6, "other words here", None), (None, "no id at all", "fr"), (7, "1234 !!! 5678", "en"), (8, "naïve café ünïcödé 𝔘𝔫𝔦 😀 text", "fr")]
