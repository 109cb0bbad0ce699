"""Benchmark decontamination by spaced seeds.

Texts become words (lower case, runs of letters and digits) and words become hashes. Fixed masks say which positions
of a window count; the hash of those words is a seed, so a substituted word at an ignored position leaves the seed as
it is. The seeds of all positions of a text are joined to the seeds of the benchmark. Around each hit the item and the text are laid along each other
(`reach` words to each side, within the item), and the hit is extended to its best local run (a word that agrees counts 1,
one that does not -3). An item overlaps a text when one run has `min_run` words that agree; or the runs that lie within `band`
words of one line (inserted or lost words shift them) hold `min_share` of the item; or `min_share` of all words laid along
each other agree.

All of it is DataFrame operations: texts are read once and, with a bounded benchmark, never shuffled; only hits move.
Bounds: the seeds are counted before they are broadcast; above `max_seeds` the join is an ordinary
shuffled one of (text key, position, seed), and only texts with a hit are read again for the words around it. Items too short for the masks use one
contiguous mask of their own length, so an item of one word overlaps every text that holds the word (`min_words` sets another bound).
Edge cases: null and empty texts or items overlap nothing; very long texts are read whole; ties (several places or items
that fit alike) all report, a text and an item once, with the best figures; repeated rows give repeated decisions; equal items all
report; an empty table on either side gives no rows; extra columns are ignored here and pass through `drop_leaks`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import content_key, text_or_empty

# The masks; 1 is a position that counts.
MASKS = ("11011011", "1011010011")


def words(text: Column) -> Column:
    """Hashes of the words of a text."""
    flat = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(flat == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(flat, " "), lambda w: F.xxhash64(w)))


def starts(w: Column, mask: str) -> Column:
    """Positions at which the mask fits."""
    return F.when(F.size(w) >= len(mask), F.sequence(F.lit(0), F.size(w) - len(mask))).otherwise(F.array().cast("array<int>"))


def seed(w: Column, at: Column, mask: str) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get(w, at + k) for k, c in enumerate(mask) if c == "1"])


def _seed_of(mask: str) -> Callable[[Column], Column]:
    return lambda i: seed(F.col("w"), i, mask)


def _extension(agrees: Column) -> Column:
    """Length of the best-scoring beginning of an array of booleans."""

    def add(acc: Column, a: Column) -> Column:
        score, at = acc["score"] + F.when(a, 1).otherwise(-3), acc["at"] + 1
        better = score > acc["best"]
        return F.struct(score.alias("score"), at.alias("at"), F.greatest(score, acc["best"]).alias("best"), F.when(better, at).otherwise(acc["len"]).alias("len"))

    zero = F.lit(0)
    return F.aggregate(agrees, F.struct(zero.alias("score"), zero.alias("at"), zero.alias("best"), zero.alias("len")), add, lambda acc: acc["len"])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", reach: int = 64, min_share: float = 0.5, min_run: int = 13, band: int = 8, max_seeds: int = 1 << 22, min_words: int = 1) -> DataFrame:
    """doc_id, node (content key), item_id, matched, compared: the overlap of each text and item, as words of the item that
    the text holds in one place and words of the item."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", words(text_or_empty("text")).alias("item")).filter(F.size("item") >= max(1, min_words))
    longest = max(map(len, MASKS))
    short = sorted(r[0] for r in items.filter(F.size("item") < longest).select(F.size("item")).distinct().collect())  # fewer than the longest mask has positions
    masks = [(m, None) for m in MASKS] + [("1" * n, n) for n in short]
    parts = []
    for k, (m, n) in enumerate(masks):
        own = items if n is None else items.filter(F.size("item") == n)
        parts.append(own.select("item_id", F.explode(starts(F.col("item"), m)).alias("j"), "item").select("item_id", "j", F.lit(k).alias("mask"), seed(F.col("item"), F.col("j"), m).alias("seed")))
    seeds = parts[0]
    for p in parts[1:]:
        seeds = seeds.unionAll(p)
    count = seeds.count()
    bounded = count <= max_seeds

    # no filter on w, and an outer explode: a filter on the arrays would be pushed below and the words made again for each position
    rows = docs.select("doc_id", content_key(text).alias("node"), words(text_or_empty(text)).alias("w"))
    arrays = [F.transform(starts(F.col("w"), m), _seed_of(m)) for m, _ in masks]
    every = rows.select("doc_id", "node", "w", F.concat(*arrays).alias("seeds"))
    hint = F.broadcast if bounded else (lambda x: x)
    first = F.lit(0)  # where the mask's seeds begin in the array
    for k in range(len(masks) - 1, 0, -1):
        before = sum((F.greatest(F.lit(0), F.col("n_words") - len(m) + 1) for m, _ in masks[:k]), F.lit(0))
        first = F.when(F.col("mask") == k, before).otherwise(first)
    i = F.col("p") - first
    if bounded:
        hits = every.select("doc_id", "node", "w", F.posexplode_outer("seeds").alias("p", "seed")).join(hint(seeds), "seed").withColumn("n_words", F.size("w"))
        met = hits.select("doc_id", "node", "item_id", "j", i.alias("i"), "w")
    else:
        slim = every.select("node", F.size("w").alias("n_words"), F.posexplode_outer("seeds").alias("p", "seed"))
        places = slim.join(seeds, "seed").select("node", "item_id", "j", i.alias("i")).distinct()
        met = rows.join(places, "node")
    left = F.greatest(F.lit(0), F.col("i") - reach)
    pairs = met.select("doc_id", "node", "item_id", "j", "i", left.alias("left"), F.slice("w", left + 1, 2 * reach).alias("near"))
    pairs = pairs.join(hint(items), "item_id")
    low = F.greatest(F.lit(0), F.col("j") - reach)
    high = F.least(F.size("item"), F.col("j") + reach)
    agrees = F.transform(F.sequence(low, high - 1), lambda p: F.coalesce((F.col("i") - F.col("j") + p >= F.col("left")) & (F.get("item", p) == F.get("near", F.col("i") - F.col("j") + p - F.col("left"))), F.lit(False)))
    pairs = pairs.select("doc_id", "node", "item_id", "j", (F.col("i") - F.col("j")).alias("line"), low.alias("low"), F.size("item").alias("n"), agrees.alias("agrees"))
    here = F.col("j") - F.col("low")
    before = _extension(F.reverse(F.slice("agrees", 1, here)))
    after = _extension(F.slice("agrees", here + 1, F.size("agrees")))
    pairs = pairs.withColumns({"from": F.col("j") - before, "to": F.col("j") + after})
    run = F.filter(F.sequence("from", F.col("to") - 1), lambda p: F.get("agrees", p - F.col("low")))
    pairs = pairs.select("doc_id", "node", "item_id", "n", "line", run.alias("run"), F.size(F.filter("agrees", lambda a: a)).alias("along"), F.size("agrees").alias("laid"))
    best = F.max(F.struct((F.col("along") / F.col("laid")).alias("share"), "along"))
    found = pairs.groupBy("doc_id", "node", "item_id", "n").agg(best.alias("best"), F.max(F.size("run")).alias("longest"), F.collect_set(F.struct("line", "run")).alias("runs"))
    beside = lambda r: F.filter("runs", lambda x: F.abs(x["line"] - r["line"]) <= band)
    together = F.array_max(F.transform("runs", lambda r: F.size(F.array_distinct(F.flatten(F.transform(beside(r), lambda x: x["run"]))))))
    found = found.withColumn("together", together)
    good = found.filter((F.col("longest") >= min_run) | (F.col("together") >= F.col("n") * min_share) | (F.col("best.share") >= min_share))
    return good.select("doc_id", "node", "item_id", F.greatest("together", "best.along").alias("matched"), F.col("n").alias("compared"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs without the rows whose text overlaps an item."""
    leaks = find_overlaps(docs, benchmark, text, **options).select(F.col("node").alias("_leak")).distinct()
    return docs.join(leaks, content_key(text) == leaks["_leak"], "left_anti")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_overlaps(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "item_id", "matched", "compared")
