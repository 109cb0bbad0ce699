"""Packing into optimal length buckets.

The global histogram of lengths is built by one aggregation; dynamic programming over it chooses at most `buckets`
upper limits that minimise the padding of all rows; inside each bucket rows form batches of at most `token_budget`
padded tokens (one row where the limit alone exceeds the budget).
Lengths up to 2**`exact_bits` are exact in the histogram; above, they fall into classes of `exact_bits` significant
bits (under 1/2048 wide by default), at every input size alike, which bounds the histogram on the driver. A class is
laid out at its longest length that occurs, so a limit is always the exact length of the bucket's longest row, and the
padding is optimal up to the width of the classes above 2**`exact_bits` (exactly where no row is that long).
Ranks inside a bucket are built from cells, so no task holds a bucket, and equal rows are one run; cells grow in number with the rows.
Edge cases: null and empty texts have length 1 (the end token); one very long text gets its own limit or shares the
last; repeated rows get a place each; ties go to the smaller limit; an empty table gives no rows; `keys` may have any names (columns
called bucket, bucket_len, batch or place give way to the results); other columns are not carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import expand_runs, keyed, materialize, ranked_runs, text_or_empty


def word_count(text: str = "text") -> Column:
    """White-space separated words and one end token."""
    return (F.regexp_count(text_or_empty(text), F.lit("[^\\x20\\x09-\\x0D]+")) + 1).cast("long")


def rounded_up(length: Column, exact_bits: int) -> Column:
    """The class of a length: above 2**exact_bits rounded up to that many significant bits."""
    step = F.shiftleft(F.lit(1).cast("long"), 0)
    for bit in range(exact_bits, 63):
        step = F.when(length > (1 << bit), F.lit(1 << (bit - exact_bits + 1)).cast("long")).otherwise(step)
    return F.ceil(length / step).cast("long") * step


def best_limits(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper limits of at most `buckets` buckets with the least padding in all: exact, by divide and conquer.

    cost(i, j) = lengths[j-1] * rows(i..j) - tokens(i..j) obeys the quadrangle inequality, so the best split of a
    prefix never moves left as the prefix grows.
    """
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate(([0.0], np.cumsum(counts.astype(np.float64))))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    splits = []
    for _ in range(min(buckets, n)):
        new, split = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        new[0] = 0.0
        stack = [(1, n, 0, n - 1)]
        while stack:
            lo, hi, a, b = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            total = best[i] + lengths[j - 1] * (rows[j] - rows[i])  # padded tokens
            at = int(np.argmin(total))
            new[j], split[j] = total[at], i[at]
            stack += [(lo, j - 1, a, split[j]), (j + 1, hi, split[j], b)]
        splits.append(split)
        best = new
    out, j = [], n
    for split in reversed(splits):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(split[j])
    return out[::-1]


RESULTS = ("bucket", "bucket_len", "batch", "place")


def pack(rows: DataFrame, length: str, keys: list[str], buckets: int = 16, token_budget: int = 65_536, exact_bits: int = 12, cell_rows: int = 50_000) -> DataFrame:
    """The columns `keys` of each row (length among them) with bucket, bucket_len, batch and place in the batch."""
    own, names = keyed(rows, keys)
    size = F.col(names[keys.index(length)])
    histogram = own.groupBy(rounded_up(size, exact_bits).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("len")).collect()  # bounded by the classes
    histogram.sort(key=lambda r: r["len"])
    limits = best_limits(np.array([r["len"] for r in histogram], dtype=np.float64), np.array([r["n"] for r in histogram]), buckets)
    bucket, bucket_len = F.lit(len(limits) - 1), F.lit(limits[-1] if limits else 0).cast("long")
    for k in range(len(limits) - 2, -1, -1):
        bucket = F.when(size <= limits[k], k).otherwise(bucket)
        bucket_len = F.when(size <= limits[k], F.lit(limits[k]).cast("long")).otherwise(bucket_len)
    cells = max(16, sum(r["n"] for r in histogram) // cell_rows)
    runs = ranked_runs(own.withColumn("bucket", bucket.cast("int")), "bucket", names, cells)
    each = expand_runs(runs, "start", "cnt", "rank").withColumn("bucket_len", bucket_len)
    per_batch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(token_budget) / F.col("bucket_len")))
    kept = [F.col(n).alias(k) for k, n in zip(keys, names, strict=True) if k not in RESULTS]
    return each.select(*kept, "bucket", "bucket_len", F.floor(F.col("rank") / per_batch).alias("batch"), F.pmod("rank", per_batch).alias("place"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    return pack(materialize(docs.select("doc_id", word_count().alias("n_tokens"))), "n_tokens", ["doc_id", "n_tokens"], **options)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
