"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import decontaminate, katz, language_id, license_scan, media_store, near_dedup, packing, pii, secret_scan, sharding


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1,
        "op2_license_scan": license_scan.op2,
        "op3_katz": katz.op3,
        "op4_near_dedup": near_dedup.op4,
        "op5_media_store": media_store.op5,
        "op6_pii": pii.op6,
        "op7_shard_ring": sharding.op7,
        "op8_secret_scan": secret_scan.op8,
        "op9_length_buckets": packing.op9,
        "op10_language_id": language_id.op10,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": license_scan.OP2_SQL,
    }
