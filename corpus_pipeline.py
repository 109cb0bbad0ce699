"""The corpus pipeline: language ID, near-duplicates, decontamination, secret scan, packing.

Every stage but the last takes documents with any columns (doc_id and text among them, other names may be anything) and
returns the same columns. In all stages: an empty table gives no rows, very long texts are read whole, and rows without a
doc_id are treated like any others (the language model does not learn from them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import decontaminate, language_id, near_dedup, packing, secret_scan
from leafmill.llm.common import materialize

SECRET_MARK = "[SECRET]"
# Fixed value: the bytes of rows that go to a Python worker at once.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches that end with the row that reaches BATCH_BYTES, where Spark would send up to 64 MB of each task at once.

    Stages are lazy, so the setting stays with the session; a value that the session already has is left as it is.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the labelled rows that are not held out.

    Null texts and texts without a letter go; ties go to the language that sorts first; repeated rows stay or go alike.
    Where no row has a label, nothing is recognised and all go.
    """
    _small_batches(spark)
    model = language_id.fit(docs, training=~language_id.held_out())
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    return language_id.identify(rows, model).filter(~F.col("rejected")).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least doc_id.

    Null texts all stay; empty texts are copies of each other; a tie (rows that repeat an id and a text) keeps one row;
    a null id comes after all others.
    """
    _small_batches(spark)
    return near_dedup.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts stay; repeated rows stay or go alike; an empty benchmark leaves all. Ties do not arise.
    """
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text.

    Null texts stay null; of spans that overlap (ties) the first decides; repeated rows are changed alike.
    """
    _small_batches(spark)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text"))
    found = secret_scan.scan_secrets(rows, redact=SECRET_MARK)
    row = F.col("_row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        same = F.col("text").eqNullSafe(F.col("_row.text"))
        row = row.withField("n_chars", F.when(same, F.col("_row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return found.select(row.alias("_row")).select("_row.*")


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch and place of each document.

    A null or empty text has one token (the end); repeated rows get a place each; ties in length go by doc_id.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("length_buckets", pack_lengths),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
