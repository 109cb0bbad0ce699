"""Streaming forms of the batch operators (an extension): inbox files as a stream, review decisions as upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.facts import upsert_last


def inbox_stream(spark: SparkSession, root: str, suffix: str = ".md") -> DataFrame:
    """path, text of Markdown files as they arrive."""
    raw = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def decisions_upsert(stream: DataFrame, table_path: str, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch rewrites the table with its last decision of each key, in a new version folder."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = f"{table_path}/v={number + 1}"
        base = spark.read.parquet(f"{table_path}/v={number}") if number else spark.createDataFrame([], batch.schema)
        upsert_last(base, batch, keys, order).write.mode("overwrite").parquet(now)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window and type, with a watermark; the same on a stream and on a table."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
