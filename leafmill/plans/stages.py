"""Stage records: upsert, resume decisions, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators.quality import latest

DONE = ("completed", "skipped")


def fold_records(records: DataFrame) -> DataFrame:
    """Latest state of each (doc_id, stage): first start, last update, last error, last known fingerprints."""
    keep = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c)
    return records.groupBy("doc_id", "stage").agg(F.min("at").alias("first_started_at"), F.max("at").alias("last_updated_at"), F.max_by("status", "ord").alias("status"), F.max_by("error", "ord").alias("error"), keep("input_fingerprint"), keep("output_fingerprint"))


def to_run(records: DataFrame, wanted: DataFrame, check_fingerprints: bool = False) -> DataFrame:
    """wanted (doc_id, stage, input_fingerprint) without what is done; with the check, a changed input runs again."""
    state = fold_records(records).filter(F.col("status").isin(*DONE)).select("doc_id", "stage", F.col("input_fingerprint").alias("_known"))
    out = wanted.join(state, ["doc_id", "stage"], "left")
    fresh = F.col("_known").isNull()
    if check_fingerprints:
        fresh = fresh | (F.col("_known") != F.col("input_fingerprint"))
        return out.filter(fresh).drop("_known")
    return wanted.join(state, ["doc_id", "stage"], "left_anti")


def fingerprint(parts: Column) -> Column:
    """SHA-256 of an array of strings, order-free."""
    return F.sha2(F.array_join(F.array_sort(parts), "\n"), 256)


__all__ = ["fold_records", "to_run", "fingerprint", "latest"]
