"""Images and other assets: content dedup, reference resolution, perceptual hashes and their clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import text as T
from leafmill.operators.graph import components
from leafmill.tables import materialize


def dedup_by_digest(assets: DataFrame, content: Column, key: str) -> DataFrame:
    """key, sha256, first_id: the least key with the same content."""
    rows = assets.select(key, F.sha2(content, 256).alias("sha256"))
    first = rows.groupBy("sha256").agg(F.min(key).alias("first_id"))
    return rows.join(first, "sha256").select(key, "sha256", "first_id")


def tail(url: Column) -> Column:
    """What follows the last slash, query and all."""
    return F.element_at(F.split(url, "/"), -1)


def unambiguous_names(urls: DataFrame, url: str = "url", key: str = "asset_id") -> DataFrame:
    """file name -> key, for names that exactly one key has."""
    names = urls.select(tail(F.col(url)).alias("name"), key)
    return names.groupBy("name").agg(F.count_distinct(key).alias("n"), F.min(key).alias(key)).filter((F.col("n") == 1) & (F.col("name") != "")).drop("n")


def resolve(refs: DataFrame, urls: DataFrame, ref: str = "ref", key: str = "asset_id", order: str | None = None) -> DataFrame:
    """refs with the key of their URL, else of their file name where that is unambiguous. A URL that comes twice has its
    last key by `order` (the greatest key without one)."""
    last = urls.groupBy(F.col("url").alias(ref)).agg((F.max(key) if order is None else F.max_by(key, order)).alias("_exact"))
    names = unambiguous_names(urls, key=key).select(F.col("name").alias("_name"), F.col(key).alias("_by_name"))
    out = refs.join(last, ref, "left").withColumn("_name", tail(F.col(ref))).join(names, "_name", "left")
    return out.withColumn(key, F.coalesce("_exact", "_by_name")).drop("_exact", "_by_name", "_name")


def registry(by_url: DataFrame, assets: DataFrame) -> DataFrame:
    """asset_id, source_url and the record of each asset: its last URL counts. by_url: url, asset_id, ord; assets: asset_id, local_path,
    sha256, mime_type (image/png where absent), ord (the first record counts)."""
    last = by_url.groupBy("asset_id").agg(F.max_by("url", "ord").alias("source_url"))
    record = assets.groupBy("asset_id").agg(F.min_by(F.struct("local_path", "sha256", "mime_type"), "ord").alias("r"))
    out = last.join(record, "asset_id", "left")
    return out.select("asset_id", "source_url", F.coalesce("r.local_path", F.lit("")).alias("local_path"), F.coalesce("r.sha256", F.lit("")).alias("sha256"), T.or_default(F.col("r.mime_type"), "image/png").alias("mime_type"))


MARK = r"!\[[^\]]*\]\([^)]+\)"


def rewrite_references(docs: DataFrame, urls: DataFrame, files: DataFrame, text: str = "text") -> DataFrame:
    """docs (doc_id, text) with the target of each image marker that `resolve` knows replaced by assets/<asset_id>.<suffix>.

    urls: url, asset_id. files: asset_id, suffix. Markers are looked up by a join; texts are cut and joined again in place.
    """
    marks = F.regexp_extract_all(F.col(text), F.lit(MARK), 0)
    each = docs.select("doc_id", F.posexplode(marks).alias("i", "mark")).withColumn("ref", T.strip(F.regexp_extract("mark", r"\]\(([^)]+)\)$", 1)))
    found = resolve(each.select("ref").distinct(), urls).join(files, "asset_id", "left").filter(F.col("asset_id").isNotNull())
    target = F.concat(F.lit("assets/"), "asset_id", F.lit("."), F.coalesce(F.nullif("suffix", F.lit("")), F.lit("bin")))
    new = each.join(found.select("ref", target.alias("target")), "ref", "left")
    new = new.withColumn("mark", F.when(F.col("target").isNotNull(), F.concat(F.regexp_extract("mark", r"^(!\[[^\]]*\])", 1), F.lit("("), "target", F.lit(")"))).otherwise(F.col("mark")))
    folded = new.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mark"))), lambda x: x["mark"]).alias("_marks"))
    pieces = F.split(F.col(text), MARK, -1)
    whole = F.array_join(F.flatten(F.zip_with(pieces, F.col("_marks"), lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
    return docs.join(folded, "doc_id", "left").withColumn(text, F.when(F.col("_marks").isNull(), F.col(text)).otherwise(whole)).drop("_marks")


def holding(docs: DataFrame, phrases: DataFrame, text: str, phrase: str, width: int = 32) -> DataFrame:
    """docs joined to the phrases that their text holds: both sides meet in an equal piece, then the text is searched.

    A text is cut once into pieces of w characters, end to end; wherever a phrase of 2w - 1 characters or more lies, one whole
    piece is among those that begin at its first w characters. w is the greatest power of two up to `width` that a phrase
    allows, so there are a few sizes at most. Only hashes of pieces meet, and what meets is written once: texts are not
    shuffled for it. An empty phrase is in every text.
    """
    size = F.greatest(*[F.when(F.length(phrase) >= 2 * w - 1, w).otherwise(1) for w in (1 << k for k in range(width.bit_length()))])
    keyed = phrases.filter(F.length(phrase) > 0).select(F.col(phrase).alias("_whole"), size.alias("_w")).distinct()
    sizes = [r["_w"] for r in keyed.select("_w").distinct().collect()]  # powers of two up to `width`
    begins = F.sequence(F.lit(1), F.least("_w", F.length("_whole") - F.col("_w") + 1))
    asked = keyed.select(F.xxhash64("_whole").alias("_p"), F.explode(F.array_distinct(F.transform(begins, lambda i: F.xxhash64(F.substring(F.col("_whole"), i, F.col("_w")))))).alias("_piece"))
    cut = [F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{{w}}}"), F.lit(0)), lambda x: F.xxhash64(x)) for w in sizes]
    pieces = F.array_distinct(F.concat(*cut)) if sizes else F.array().cast("array<bigint>")
    held = docs.select(F.xxhash64(text).alias("_t"), F.explode(pieces).alias("_piece"))
    met = materialize(held.join(asked, "_piece").select("_t", "_p").distinct())
    out = docs.withColumn("_t", F.xxhash64(text)).join(met, "_t").join(phrases.withColumn("_p", F.xxhash64(phrase)), "_p").drop("_t", "_p")
    return out.filter(F.contains(F.col(text), F.col(phrase))).unionByName(docs.filter(F.col(text).isNotNull()).crossJoin(phrases.filter(F.length(phrase) == 0)))


def sign_bits(vector: Column) -> Column:
    """A 64-bit hash of the signs of a vector's first 64 numbers, as array<long> of one word."""
    bit = lambda i: F.when(F.get(vector, i) > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    word = F.lit(0).cast("long")
    for i in range(64):
        word = word.bitwiseOR(F.shiftleft(bit(i), i))
    return F.array(word)


def hamming(a: Column, b: Column, words: int | None = None) -> Column:
    """Differing bits of two hashes of equally many 64-bit words; with the number of words known, one flat expression."""
    if words is not None:
        return sum((F.bit_count(F.get(a, w).bitwiseXOR(F.get(b, w))) for w in range(words)), F.lit(0))
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)


def _bands(limit: int, words: int) -> list[list[tuple[int, int]]]:
    """limit + 1 bands of the bits, each a list of (word, mask)."""
    total, n = 64 * words, limit + 1
    edges = [total * k // n for k in range(n + 1)]
    out = []
    for k in range(n):
        band = []
        for w in range(words):
            low, high = max(edges[k], 64 * w), min(edges[k + 1], 64 * (w + 1))
            if low < high:
                mask = ((1 << (high - low)) - 1) << (low - 64 * w)
                band.append((w, mask if mask < 1 << 63 else mask - (1 << 64)))
        out.append(band)
    return out


def _same(a: Column, b: Column, band: list[tuple[int, int]]) -> Column:
    same = F.lit(True)
    for w, mask in band:
        same = same & (F.get(a, w).bitwiseXOR(F.get(b, w)).bitwiseAND(F.lit(mask)) == 0)
    return same


def hamming_pairs(hashes: DataFrame, key: str, bits: str, limit: int, words: int = 1, others: DataFrame | None = None) -> DataFrame:
    """(a, b, distance) with distance <= limit: exact, by limit + 1 bands of which two such hashes share one.

    A pair is made in the first band that it shares only, so no pair is a row twice. With `others` (of the same columns),
    a comes from hashes and b from others; else a < b.
    """
    bands = _bands(limit, words)
    values = [F.struct(F.lit(k).alias("band"), F.xxhash64(*[F.get(bits, w).bitwiseAND(F.lit(m)) for w, m in band]).alias("value")) for k, band in enumerate(bands)]
    dealt = lambda df: df.select(F.col(key).alias("id"), F.col(bits).alias("bits"), F.explode(F.array(*values)).alias("s")).select("id", "bits", "s.*")
    left, right = dealt(hashes).alias("l"), dealt(hashes if others is None else others).alias("r")
    x, y = F.col("l.bits"), F.col("r.bits")
    first = F.lit(len(bands) - 1)
    for k in range(len(bands) - 2, -1, -1):
        first = F.when(_same(x, y, bands[k]), k).otherwise(first)
    d = hamming(x, y, words)
    near = (F.col("l.band") == F.col("r.band")) & (F.col("l.value") == F.col("r.value")) & (d <= limit) & (first == F.col("l.band"))
    met = left.join(right, near if others is not None else near & (F.col("l.id") < F.col("r.id")))
    return met.select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), d.alias("distance"))


def near_forest(hashes: DataFrame, key: str, bits: str, limit: int, words: int = 1, block: int = 8192) -> DataFrame:
    """(a, b): pairs of keys that connect what all pairs within `limit` connect, and fewer of them; exact.

    All pairs are compared, since near hashes of this radius share no key that would keep most others away. Keys with equal
    bits are joined to the least of them first. The other hashes are dealt by value into groups of about `block`; each pair
    of groups is one row of work, compares packed words in slices and returns a spanning forest of what it found, which has
    fewer edges than the two groups have hashes. A worker holds two groups; no group is on the driver.
    """
    import numpy as np
    import pandas as pd

    word = [F.get(bits, w).alias(f"w{w}") for w in range(words)]
    names = [f"w{w}" for w in range(words)]
    rows = hashes.select(F.col(key).alias("id"), *word)
    lone = materialize(rows.groupBy(*names).agg(F.min("id").alias("first")))
    same = rows.join(lone, names).filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    n = max(1, -(-lone.count() // block))
    group = F.pmod(F.xxhash64(*names), F.lit(n)).cast("int")
    folded = lone.select("first", *names, group.alias("g")).groupBy("g").agg(F.collect_list(F.struct("first", *names)).alias("rows"))
    folded = materialize(folded.select("g", F.col("rows.first").alias("ids"), *[F.col(f"rows.{w}").alias(w) for w in names]))
    left = folded.select(*[F.col(c).alias(f"l_{c}") for c in folded.columns])
    # a group meets each group from its own on: pairs of numbers first, dealt out, then the rows of both
    pairs = folded.sparkSession.range(n).select(F.col("id").cast("int").alias("l_g"), F.explode(F.sequence(F.col("id").cast("int"), F.lit(n - 1))).alias("g"))
    work = pairs.join(left, "l_g").join(folded, "g").repartition(max(1, min(2000, n * (n + 1) // 2)), "l_g", "g")

    def compare(batches):
        for part in batches:
            for row in part.to_dict("records"):
                x, y = row["l_ids"], row["ids"]
                own = row["l_g"] == row["g"]
                p, q = (np.stack([np.asarray(row[side + w], np.int64).view(np.uint64) for w in names], 1) for side in ("l_", ""))
                tree, shift = np.arange(len(x) + (0 if own else len(y))), 0 if own else len(x)
                kept: list[tuple[int, int]] = []
                for at in range(0, len(x), 256):
                    far = np.zeros((len(p[at : at + 256]), len(q)), np.uint16)
                    for w in range(words):
                        far += np.bitwise_count(p[at : at + 256, w, None] ^ q[None, :, w])
                    near = far <= limit
                    for i in np.flatnonzero(near.any(axis=1)):
                        js = np.flatnonzero(near[i])
                        for other, j in zip(*np.unique(tree[js + shift], return_index=True), strict=True):
                            if other != tree[at + i]:
                                tree[tree == other] = tree[at + i]
                                kept.append((x[at + i], y[js[j]]))
                yield pd.DataFrame(kept, columns=["a", "b"])

    kind = hashes.schema[key].dataType.simpleString()
    return same.unionByName(work.mapInPandas(compare, f"a {kind}, b {kind}"))


def clusters(nodes: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """key, cluster: the least key of each connected component; every node has a row.

    The pairs are written once; components come from contraction, which ends when no pair is left.
    """
    found = components(pairs).select(F.col("node").alias(key), F.col("component").alias("cluster"))
    return nodes.select(key).join(found, key, "left").select(key, F.coalesce("cluster", key).alias("cluster"))


def visually_equal(members: DataFrame, max_ratio: float = 5.0, min_side: float = 0.5) -> DataFrame:
    """cluster, members, representative, equal: sizes within a ratio and sides alike; members has cluster, id, bytes, width, height.

    A cluster with a member of no bytes is not equal, nor is one with a member of no width and height.
    """
    long = F.greatest("width", "height")
    side = F.when(long == 0, 0.0).otherwise(F.try_divide(F.least("width", "height"), long))
    g = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.max_by("id", F.struct("bytes", F.col("width").cast("long") * F.col("height"), -F.col("id"))).alias("representative"), F.try_divide(F.max("bytes"), F.min("bytes")).alias("ratio"), F.min(side).alias("side"))
    return g.select("cluster", "members", "representative", ((F.col("members") >= 2) & F.coalesce(F.col("ratio") < max_ratio, F.lit(False)) & (F.col("side") > min_side)).alias("equal"))


def nearest_references(hashes: DataFrame, references: DataFrame, limit: int = 18, top: int = 20, words: int = 4) -> DataFrame:
    """ref_id, id, distance, rank: the nearest hashes (id, bits) of each reference (ref_id, ref_bits); ties go to the lower id."""
    refs = references.select(F.col("ref_id").alias("id"), F.col("ref_bits").alias("bits"))
    met = hamming_pairs(hashes.select("id", "bits"), "id", "bits", limit, words, others=refs)
    w = W.partitionBy("b").orderBy("distance", "a")
    ranked = met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.select(F.col("b").alias("ref_id"), F.col("a").alias("id"), "distance", "rank")


def difference_hash(images: DataFrame, key: str, side: int = 16) -> DataFrame:
    """key, bits array<long>: of images read by Spark's image source, box-averaged to (side + 1) x side greys, left > right."""
    import numpy as np
    import pandas as pd

    def work(batches):
        for part in batches:
            rows = []
            for k, h, w, c, data in part.itertuples(index=False):
                if w <= 0 or h <= 0:
                    continue
                px = np.frombuffer(data, np.uint8).reshape(h, w, c).astype(np.float64)
                grey = px[..., 0] if c == 1 else px[..., :3] @ np.array([0.114, 0.587, 0.299])
                ys, xs = np.arange(side + 1) * h // side, np.arange(side + 2) * w // (side + 1)
                cell = np.array([[grey[ys[i] : max(ys[i] + 1, ys[i + 1]), xs[j] : max(xs[j] + 1, xs[j + 1])].mean() for j in range(side + 1)] for i in range(side)])
                bits = np.packbits((cell[:, :-1] > cell[:, 1:]).ravel())
                rows.append((k, [int(x) for x in bits.view(">i8")]))
            yield pd.DataFrame(rows, columns=[key, "bits"])

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(work, f"{key} {kind}, bits array<long>")


def effective_role(uses: DataFrame, records: DataFrame, overrides: DataFrame) -> DataFrame:
    """figure_id, item_id, role: override of the figure, record of the use, last record of the figure, else ambiguous."""
    o = overrides.groupBy("figure_id").agg(F.max_by("role", "ord").alias("o"))
    u = records.groupBy("figure_id", "item_id").agg(F.max_by("role", "ord").alias("u"))
    f = records.groupBy("figure_id").agg(F.max_by("role", "ord").alias("f"))
    out = uses.join(o, "figure_id", "left").join(u, ["figure_id", "item_id"], "left").join(f, "figure_id", "left")
    return out.select("figure_id", "item_id", F.coalesce("o", "u", "f", F.lit("ambiguous")).alias("role"))
