"""Near-duplicate classes by ProbMinHash, banding and verification.

Shingles are five consecutive words (runs of ASCII letters, digits and non-ASCII characters of the lower-cased text; a
text of one to four words is one shingle), weighted by 1 + ln(count). Each shingle is a Poisson process whose rate is
its weight; each arrival falls on one of `size` components by a hash, and a component keeps the shingle that arrives
first. A shingle stops as soon as its next arrival is later than every component's first. Two sketches agree in a
component with the probability Jaccard similarity of the two weighted sets. Bands of `rows` components find
candidates, and each link is verified on the whole texts by the exact probability Jaccard similarity.

Exact copies are one node from the start. A band's bucket is not paired out: its members are compared with the one
that meets most other members over all bands (a star), verified links are contracted to components, and only buckets whose rest still lies in several components
go on, with more members as centres each round, until every two members that share a bucket have been compared or
are connected. There the sketches are compared first, inside the join: a pair whose texts are similar enough fails that
with a chance under 0.03 %, and only pairs that pass become rows. So no candidate is capped, and a large group of near
copies costs a few comparisons a member. At similarity 0.8 the bands miss 0.3 % of pairs, at 0.85 one in 25,000.

Edge cases: very long texts are read whole; ties (the same similarity, the same weight) do not change classes; a null text is its own class; equal texts (empty ones too) are one class; texts without words are linked by
equality only; a class is named by its least doc_id; repeated rows keep their rows; an empty table gives no rows;
extra columns are not carried by `classes` and pass through `keep_first`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.llm.common import WORD_BYTES, content_key, materialize, mix64, word_hashes
from leafmill.operators.graph import components, relabel

WIDTH = 5
_ODD = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_TO_UNIT = 2.0**-53


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and their weights."""
    words = word_hashes(text.lower().encode("utf-8", "replace"), WORD_BYTES)[0]
    if not len(words):
        return words, np.zeros(0)
    if len(words) < WIDTH:
        h = mix64(np.array([(words * _ODD[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))]))
    else:
        n = len(words) - WIDTH + 1
        h = np.zeros(n, dtype=np.uint64)
        for k in range(WIDTH):
            h += words[k : k + n] * _ODD[k]
        h = mix64(h)
    unique, counts = np.unique(h, return_counts=True)
    return unique, 1.0 + np.log(counts)


def prob_minhash(hashes: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The shingle that arrives first at each of `size` components."""
    first, winner = np.full(size, np.inf), np.zeros(size, dtype=np.uint64)
    at, done = np.zeros(len(hashes)), 0
    while len(hashes):
        many = max(1, min(64, 2 * size // len(hashes)))
        step = mix64(hashes[:, None] + np.arange(done + 1, done + many + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        gap = -np.log(((step >> np.uint64(11)).astype(np.float64) + 0.5) * _TO_UNIT) / weights[:, None]
        arrival = at[:, None] + np.cumsum(gap, axis=1)
        where = (mix64(step) % np.uint64(size)).astype(np.int64).ravel()
        order = np.argsort(-arrival, axis=None, kind="stable")  # the earliest is written last
        t, by = np.full(size, np.inf), np.zeros(size, dtype=np.uint64)
        t[where[order]] = arrival.ravel()[order]
        by[where[order]] = np.repeat(hashes, many)[order]
        better = t < first
        first[better], winner[better] = t[better], by[better]
        going = arrival[:, -1] < first.max()
        hashes, weights, at, done = hashes[going], weights[going], arrival[going, -1], done + many
    return winner


def sketch_text(text: str | None, size: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each band of the sketch, and one byte of each component; both empty for a text without words."""
    h, w = shingles(text or "")
    if not len(h):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int8)
    winner = prob_minhash(h, w, size)
    z = winner.reshape(-1, rows)
    bands = mix64((z * _ODD[:rows]).sum(axis=1, dtype=np.uint64) + np.arange(len(z), dtype=np.uint64)).view(np.int64)
    return bands, (winner & np.uint64(255)).astype(np.uint8).view(np.int8)


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity: the sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    (a, wa), (b, wb) = one, two
    union = np.union1d(a, b)
    if not len(union):
        return 0.0
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a)], y[np.searchsorted(union, b)] = wa, wb
    ratio = np.full(len(union), np.inf)
    np.divide(x, y, out=ratio, where=y > 0)
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    from_right, from_left = np.cumsum(x[::-1])[::-1], np.cumsum(y)
    both = (x > 0) & (y > 0)
    at = np.searchsorted(ratio, ratio[both], side="left")
    below = np.where(at > 0, from_left[at - 1], 0.0)
    return float((1.0 / (from_right[at] / x[both] + below / y[both])).sum())


def _sketched(docs: DataFrame, text: str, size: int, rows: int) -> DataFrame:
    @F.pandas_udf("bands array<long>, bytes array<tinyint>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame([sketch_text(t, size, rows) for t in part], columns=["bands", "bytes"])

    keyed = docs.filter(F.col(text).isNotNull()).select("doc_id", content_key(text).alias("node"), F.col(text).alias("_body"))
    return materialize(keyed.withColumn("s", sketch.asNondeterministic()("_body")).select("doc_id", "node", "s.*"))


def _maybe(one: str, two: str, size: int, threshold: float) -> Column:
    """Whether the sketches leave a similarity of the threshold possible: 3.5 standard deviations are allowed for."""
    equal = F.size(F.filter(F.zip_with(one, two, lambda x, y: x == y), lambda same: same))
    return equal >= size * threshold - 3.5 * math.sqrt(size * threshold * (1 - threshold))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    @F.pandas_udf("double")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last, known = None, None
        for left, right in batches:
            out = []
            for x, y in zip(left, right, strict=True):
                if y != last:
                    last, known = y, shingles(y)
                out.append(similarity(shingles(x), known))
            yield pd.Series(out, dtype=float)

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("right")), "b").join(texts.select(F.col("node").alias("a"), F.col("body").alias("left")), "a")
    return materialize(both.withColumn("s", compare.asNondeterministic()("left", "right")).filter(F.col("s") >= threshold).select("a", "b"))


def _labelled(pairs: DataFrame, found: DataFrame, end: str) -> DataFrame:
    """pairs with that end replaced by its component."""
    label = found.select(F.col("node").alias(end), F.col("component").alias("_label"))
    return pairs.join(label, end, "left").withColumn(end, F.coalesce("_label", end)).drop("_label")


def classes(docs: DataFrame, text: str = "text", size: int = 256, rows: int = 8, threshold: float = 0.8, compare_sketches: bool = True) -> DataFrame:
    """doc_id, node (content key, null for a null text), class_id and first_node of the class, for each row.

    Without `compare_sketches` every pair that shares a bucket and is not connected yet is verified on its texts.
    """
    base = _sketched(docs, text, size, rows)
    named = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")
    nodes = materialize(base.groupBy("node").agg(F.min(named).alias("first"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes")))
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = materialize(banded.join(shared, "bucket"))
    # the member that meets most others is the centre: of copies with edits, that is one with few edits of its own
    central = met.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = materialize(met.select("bucket", "node").join(central, "node"))
    centre = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top"))
    starred = materialize(weighed.select("bucket", "node").join(centre.select("bucket", F.col("top.node").alias("b")), "bucket"))
    wanted = starred.select("node").distinct().join(nodes.select("node", "first.doc_id"), "node")
    keyed = docs.filter(F.col(text).isNotNull()).select("doc_id", content_key(text).alias("node"), F.col(text).alias("body"))
    same = (keyed["node"] == wanted["node"]) & keyed["doc_id"].eqNullSafe(wanted["doc_id"])
    texts = materialize(keyed.join(wanted, same, "left_semi").groupBy("node").agg(F.first("body").alias("body")))

    pairs = materialize(starred.filter(F.col("node") != F.col("b")).select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct())
    tested = pairs
    found = components(_verified(pairs, texts, threshold))
    rest, centres = starred.filter(F.col("node") != F.col("b")).select("bucket", "node"), 128
    while True:
        placed = rest.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        open_ = placed.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 != c2").select("bucket")
        rest = materialize(placed.join(open_, "bucket", "left_semi"))
        if rest.isEmpty():
            break
        sizes = rest.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
        main = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("k", "component")).alias("main"))
        order = W.partitionBy("bucket").orderBy("node")
        chosen = rest.join(main, "bucket").filter(F.col("component") != F.col("main")).select("bucket", F.col("node"), F.col("component")).withColumn("i", F.row_number().over(order)).filter(F.col("i") <= centres)
        chosen = materialize(chosen.select("bucket", F.col("node").alias("c"), F.col("component").alias("c_component")))
        left = rest.join(nodes.select("node", "bytes", "bands"), "node")
        right = chosen.join(nodes.select(F.col("node").alias("c"), F.col("bytes").alias("c_bytes"), F.col("bands").alias("c_bands")), "c")
        # a pair counts in the first bucket that it shares, so it is one row
        once = F.get(F.filter(F.zip_with("bands", "c_bands", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()), 0) == left["bucket"]
        near = (left["bucket"] == right["bucket"]) & (left["component"] != right["c_component"]) & once & (_maybe("bytes", "c_bytes", size, threshold) if compare_sketches else F.lit(True))
        across = left.join(right, near)
        pairs = across.select(F.greatest("node", "c").alias("a"), F.least("node", "c").alias("b")).distinct()
        pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"))
        tested, more = tested.unionAll(pairs), _verified(pairs, texts, threshold)
        if not more.isEmpty():
            ends = _labelled(_labelled(more, found, "a"), found, "b")
            joined = components(ends)  # of components
            lone = joined.join(found.select("node"), "node", "left_anti")
            found = materialize(relabel(found, joined).unionByName(lone))
        rest = rest.select("bucket", "node").join(chosen.select("bucket", F.col("c").alias("node")), ["bucket", "node"], "left_anti")
        centres *= 4
    whole = nodes.select("node", "first").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(whole.groupBy("component").agg(F.min("first").alias("lead")).join(whole.select("node", "component"), "component").select("node", "lead"))
    out = base.select("doc_id", "node").join(named, "node").select("doc_id", "node", F.col("lead.doc_id").alias("class_id"), F.col("lead.node").alias("first_node"))
    alone = docs.filter(F.col(text).isNull()).select("doc_id", F.lit(None).cast("binary").alias("node"), F.col("doc_id").alias("class_id"), F.lit(None).cast("binary").alias("first_node"))
    return out.unionByName(alone)


def keep_first(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs with one row of each class: the row with the least doc_id (null texts all stay)."""
    found = classes(docs, text, **options).filter(F.col("node").isNotNull())
    lead = found.select(F.col("class_id").alias("_id"), F.col("first_node").alias("_key")).distinct()
    body = F.col(f"_row.{text}")
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    keyed = rows.filter(body.isNotNull()).withColumns({"_node": content_key(f"_row.{text}"), "_doc": F.col("_row.doc_id")})
    kept = keyed.join(lead, (F.col("_node") == F.col("_key")) & F.col("_doc").eqNullSafe(F.col("_id")))
    once = kept.withColumn("_i", F.row_number().over(W.partitionBy("_node", "_doc").orderBy("_doc"))).filter("_i = 1")
    return once.select("_row").unionByName(rows.filter(body.isNull())).select("_row.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "class_id")
