"""Shared helpers: row ranking, word hashes; the tables in the shared folder come from the core."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.tables import discard, materialize, shared_dir

__all__ = ["discard", "materialize", "shared_dir"]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the column's text form modulo `modulus`; null stays null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)).cast("int")


def content_key(column: str = "text") -> Column:
    """16 bytes that name a text (null: the empty text)."""
    return F.unhex(F.md5(text_or_empty(column).cast("binary")))


def keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The columns `keys` under helper names, so that no name of the caller's meets one of ours."""
    names = [f"_k{i}" for i in range(len(keys))]
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]), names


def ranked_runs(df: DataFrame, part: str, keys: list[str], cells: int) -> DataFrame:
    """Distributed ranking of rows inside each value of `part`, with no task holding a whole part.

    Equal rows collapse to one run with a multiplicity `cnt` (so a row repeated for a third of the table is one record).
    Runs are dealt by (part, cell), the cell being a hash of the keys; a window orders each cell, and the rows of the
    cells before it are added afterwards. Returns the runs with `start`, the rank (from 0) of a run's first row.
    """
    runs = df.groupBy(part, *keys).agg(F.count(F.lit(1)).alias("cnt")).withColumn("_cell", F.pmod(F.xxhash64(*keys), F.lit(cells)).cast("int"))
    w = W.partitionBy(part, "_cell").orderBy(*keys).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = runs.withColumn("_in_cell", F.sum("cnt").over(w) - F.col("cnt"))
    totals = runs.groupBy(part, "_cell").agg(F.sum("cnt").alias("_rows"))
    before = W.partitionBy(part).orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = totals.withColumn("_before", F.sum("_rows").over(before) - F.col("_rows")).drop("_rows")  # a row for each cell
    return placed.join(offsets, [part, "_cell"]).withColumn("start", F.col("_before") + F.col("_in_cell")).drop("_cell", "_in_cell", "_before")


def expand_runs(df: DataFrame, start: str, count: str, out: str, chunk: int = 50_000) -> DataFrame:
    """One row for each position of each run [start, start + count); long runs are cut into chunks that are dealt anew."""
    many = df.filter(F.col(count) > chunk)
    single = df.filter(F.col(count) <= chunk).withColumn(out, F.explode(F.sequence(F.col(start), F.col(start) + F.col(count) - 1)))
    cut = many.withColumn("_from", F.explode(F.sequence(F.col(start), F.col(start) + F.col(count) - 1, F.lit(chunk))))
    cut = cut.withColumn("_to", F.least(F.col("_from") + chunk, F.col(start) + F.col(count)) - 1).repartition("_from", start)
    return single.unionByName(cut.withColumn(out, F.explode(F.sequence("_from", "_to"))).drop("_from", "_to"))


WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
WORD_BYTES[128:] = True

SPACE_BYTES = np.ones(256, dtype=bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x100000001B3)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def word_hashes(raw: bytes, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the maximal runs of word bytes in raw, and the offset of the first byte of each."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = word_bytes[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    power = np.cumprod(np.full(int(lengths.max()) + 1, _P, dtype=np.uint64))
    kept = data[inside].astype(np.uint64) + np.uint64(1)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    kept *= power[np.arange(len(kept)) - np.repeat(first, lengths)]
    return mix64(np.add.reduceat(kept, first) + lengths.astype(np.uint64)), starts
