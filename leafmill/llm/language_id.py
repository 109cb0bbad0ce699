"""Language identification by nearest centroid.

Texts become L2-normalised TF-IDF vectors of hashed byte trigrams of their letters. For each language a bounded
sample of labelled rows is clustered (spherical k-means) into several centroids; a text gets the language of the
centroid with the highest cosine, and is rejected when that cosine is below the language's limit. The limit lies in
the middle between the least cosines of the language's own rows and the usual ones of the other languages, over rows that were
not fitted; texts of few trigrams have lower limits, in proportion to the cosine that they can reach.

Bound: at most `sample_per_language` rows (default 400) of each label are fitted and a third as many set the limits,
taken by a hash of doc_id, so the model has at most languages x `clusters` x `dims` numbers. Everything else covers all rows.
Edge cases: a null text, or one without a letter, gets `und`, score 0 and rejected = true; an empty or unlabelled
table learns nothing and predicts `und`; very long texts are read whole; ties go to the language that sorts first; repeated rows are scored
alike, and of rows that repeat an id in the sample the least text is fitted, whatever their order; rows without an id are not fitted;
extra columns pass through, and the output columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.llm.common import crc_mod, materialize

UNKNOWN = "und"
_LETTER = np.full(256, 32, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def gram_counts(text: str, dims: int) -> np.ndarray:
    """Counts of hashed trigrams over the letters of text; other characters part words."""
    data = _LETTER[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8)]
    keep = data != 32
    keep[1:] |= data[:-1] != 32
    keep[0] = True
    data = data[keep].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(dims, dtype=np.int64)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    code *= np.uint32(2654435769)
    return np.bincount(code >> np.uint32(32 - (dims - 1).bit_length()), minlength=dims)


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def _halves(x: np.ndarray) -> np.ndarray:
    """Which rows lie above the median along the rows' main direction."""
    y = x - x.mean(axis=0)
    gram = (y @ y.T).astype(np.float64)
    along = np.linalg.eigh(gram)[1][:, -1] if gram.max() > 1e-6 else np.zeros(len(x))
    middle = np.median(along)
    upper = along > middle
    return upper if upper.any() else along < middle


def _means(x: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    c = np.stack([x[own == i].mean(axis=0) for i in range(k)])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, clusters: int, rounds: int = 24) -> np.ndarray:
    """Centroids of spherical k-means. Seeds are halves of the largest clusters, as a single row far from all draws no others to it
    (such seeds end as clusters of one odd row); rounds end before one that leaves a cluster under 5 % of the rows."""
    own, k, whole = np.zeros(len(x), dtype=np.int64), 1, set()
    while k < clusters and len(whole) < k:
        sizes = np.bincount(own, minlength=k)
        big = max(set(range(k)) - whole, key=lambda i: (sizes[i], -i))
        at = np.flatnonzero(own == big)
        upper = _halves(x[at])
        if upper.any():
            own[at[upper]] = k
            k += 1
        else:
            whole.add(big)  # equal rows
    c = _means(x, own, k)
    for _ in range(rounds):
        new = (x @ c.T).argmax(axis=1)
        if (new == own).all() or np.bincount(new, minlength=k).min() < 0.05 * len(x):
            break
        own = new
        c = _means(x, own, k)
    return c


def _room(grams: np.ndarray, full: int = 64) -> np.ndarray:
    """How much of a centroid a text of so many distinct trigrams can meet, at most 1.

    The cosine of g equal weights with a centroid grows as the root of g, so a text of few words is far from every centroid
    in any language; limits shrink alike below `full` trigrams.
    """
    return np.minimum(1.0, np.sqrt(np.maximum(grams, 1) / full))


def _limit(inside: np.ndarray, outside: np.ndarray) -> float:
    """The middle between the cosines that 99 % of the language's own rows and half of the other languages' rows exceed. The other
    rows' upper part says little, since documents that mix languages make it; where it overlaps, 99 % of the own rows still stay."""
    low = float(np.quantile(outside, 0.5)) if len(outside) else 0.0
    own = float(np.quantile(inside, 0.01)) if len(inside) else low
    return min(own, (low + own) / 2)


class Model:
    """Centroids (rows), their languages, rejection limits and the IDF weights."""

    def __init__(self, languages: list[str], centroids: np.ndarray, limits: np.ndarray, idf: np.ndarray):
        self.languages, self.centroids, self.limits, self.idf = languages, centroids, limits, idf


def fit(docs: DataFrame, text: str = "text", label: str = "lang", sample_per_language: int = 400, clusters: int = 4, dims: int = 8192, training: Column | None = None) -> Model:
    """Fit on at most sample_per_language rows of each label, and set the limits on a third as many others; `training` says which rows may be used."""
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).rlike("\\p{L}"))
    if training is not None:
        rows = rows.filter(training)
    rows = rows.select("doc_id", F.col(label).alias("label"), F.col(text).alias("body"))
    # a hash threshold keeps about twice the bound of each label before rows are ranked, so the ranked rows are few too
    known = rows.filter(F.col("doc_id").isNotNull()).withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / (1 << 40))
    rates = [(r["label"], 2.0 * sample_per_language / r["count"]) for r in known.groupBy("label").count().collect()]  # one row a label, as the model has
    few = known.join(F.broadcast(docs.sparkSession.createDataFrame(rates, "label string, rate double")), "label").filter(F.col("draw") < F.col("rate"))
    order = W.partitionBy("label").orderBy("draw", "doc_id")
    once = few.groupBy("label", "doc_id").agg(F.min("draw").alias("draw"), F.min("body").alias("body"))  # of rows that repeat an id, the least text
    chosen = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample_per_language * 4 // 3)

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = [(lab, apart, np.flatnonzero(c := gram_counts(t, dims)), c[c > 0]) for lab, apart, t in zip(part["label"], part["apart"], part["body"], strict=True)]
            yield pd.DataFrame(out, columns=["label", "apart", "at", "n"])

    drawn = materialize(chosen.select("label", (F.col("rank") % 4 == 0).alias("apart"), "body").mapInPandas(sparse, "label string, apart boolean, at array<int>, n array<int>"))
    sample = drawn.filter(~F.col("apart"))
    total = sample.count()
    idf = np.full(dims, np.log(1.0 + total) + 1.0, dtype=np.float32)
    for at, n in sample.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # at most dims rows
        idf[at] = np.log((1.0 + total) / (1.0 + n)) + 1.0

    def dense(part: pd.DataFrame) -> np.ndarray:
        counts = np.zeros((len(part), dims), dtype=np.int32)
        for i, (at, n) in enumerate(zip(part["at"], part["n"], strict=True)):
            counts[i, at] = n
        return _vectors(counts, idf)

    def centroids(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = dense(part)
        c = _cluster(x[np.lexsort(x[:, :16].T)], clusters)
        return pd.DataFrame({"label": [key[0]] * len(c), "centroid": list(c)})

    found = sample.groupBy("label").applyInPandas(centroids, "label string, centroid array<float>").collect()
    found.sort(key=lambda r: (r["label"], r["centroid"]))
    labels = np.array([r["label"] for r in found], dtype=object)
    names = sorted(set(labels))
    c = np.array([r["centroid"] for r in found], dtype=np.float32).reshape(len(found), dims)
    shared = docs.sparkSession.sparkContext.broadcast(c)

    def cosines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for k in range(0, len(part), 128):
                rows = part.iloc[k : k + 128]
                room = _room(np.array([len(at) for at in rows["at"]]))
                cosine = dense(rows) @ shared.value.T / room[:, None]
                for name in names:
                    yield pd.DataFrame({"label": name, "inside": (rows["label"] == name).to_numpy(), "cosine": cosine[:, labels == name].max(axis=1)})

    apart = drawn.filter("apart").mapInPandas(cosines, "label string, inside boolean, cosine double")
    limits = apart.groupBy("label").applyInPandas(lambda key, x: pd.DataFrame({"label": [key[0]], "edge": [_limit(x["cosine"][x["inside"]].to_numpy(), x["cosine"][~x["inside"]].to_numpy())]}), "label string, edge double")
    edge = {r["label"]: r["edge"] for r in limits.collect()}
    return Model(list(labels), c, np.array([edge.get(name, 0.0) for name in labels]), idf)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score (cosine, 0 to 1) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        dims = len(m.idf)
        for part in batches:
            lang, score, rejected = [UNKNOWN] * len(part), np.zeros(len(part)), np.ones(len(part), dtype=bool)
            known = [i for i, t in enumerate(part) if t and m.languages and any(map(str.isalpha, t))]
            for k in range(0, len(known), 128):
                rows = known[k : k + 128]
                counts = np.stack([gram_counts(part.iloc[i], dims) for i in rows])
                cosine = _vectors(counts, m.idf) @ m.centroids.T
                room = _room((counts > 0).sum(axis=1))
                for i, at, c, r in zip(rows, cosine.argmax(axis=1), cosine.max(axis=1), room, strict=True):
                    lang[i], score[i], rejected[i] = m.languages[at], min(1.0, max(0.0, float(c))), bool(c < m.limits[at] * r)
            yield pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})

    out = docs.withColumn("_found", nearest.asNondeterministic()(F.col(text)))
    return out.withColumns({"lang_pred": F.col("_found.lang"), "score": F.col("_found.score"), "rejected": F.col("_found.rejected")}).drop("_found")


def held_out() -> Column:
    return F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs, training=~held_out())
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
