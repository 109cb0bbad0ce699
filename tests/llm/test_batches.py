"""The pipeline's stages send texts to Python in batches bounded in bytes."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("stage", ["language_id", "near_dedup", "secret_scan"])
def test_batches_are_bounded(spark, folder_of, stage):
    own = spark.newSession()
    docs = own.read.parquet(folder_of([(i, f"some words of text {i}", "en") for i in range(20)]) + "/documents.parquet")
    dict(corpus_pipeline.STAGES)[stage](own, docs, "")

    def sent(texts: pd.Series) -> pd.Series:  # the bytes of the batch
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    long = own.range(0, 2000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
    assert long.select(F.pandas_udf(sent, "long")("text").alias("n")).agg(F.max("n")).first()[0] <= (2 << 20) + 5000  # the row that reaches the limit is whole


def test_a_setting_of_the_session_stays(spark, folder_of):
    own = spark.newSession()
    own.conf.set(SETTING, "4m")
    docs = own.read.parquet(folder_of([(1, "some words", "en")]) + "/documents.parquet")
    corpus_pipeline.redact_secrets(own, docs, "")
    assert own.conf.get(SETTING) == "4m"
