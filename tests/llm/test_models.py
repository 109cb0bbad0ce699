import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from leafmill.llm import katz, language_id


def katz_brute(texts, train, order, k=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + ["</s>"] for t in texts]
    before = lambda d, i, n: tuple(d[j] if j >= 0 else "<s>" for j in range(i - n + 1, i))
    counts = {n: Counter((*before(d, i, n), w) for d, m in zip(docs, train, strict=True) if m for i, w in enumerate(d)) for n in range(1, order + 1)}
    uni = {w: c for (w,), c in counts[1].items()}
    total, types = sum(uni.values()), len(uni)
    d = {n: katz.discounts([Counter(c.values())[r] for r in range(1, k + 2)], k) for n, c in counts.items()}
    after = {n: defaultdict(dict) for n in counts}
    for n, c in counts.items():
        for gram, x in c.items():
            after[n][gram[:-1]][gram[-1]] = x
    seen = sum(d[1][min(c, k + 1)] * c for c in uni.values()) / total
    unknown = max(1 - seen, 0.5 / (total + 0.5 * (types + 1)))

    def p(ctx, w):
        n = len(ctx) + 1
        if n == 1:
            return d[1][min(uni[w], k + 1)] * uni[w] / total * (1 - unknown) / seen if w in uni else unknown
        if ctx not in after[n]:
            return p(ctx[1:], w)
        own = after[n][ctx]
        all_ = sum(own.values())
        mass = sum(d[n][min(c, k + 1)] * c for c in own.values()) / all_
        left = max(1 - mass, 0.5 / (all_ + 1))
        if w in own:
            return d[n][min(own[w], k + 1)] * own[w] / all_ * (1 - left) / mass
        return left / (1 - sum(p(ctx[1:], x) for x in own)) * p(ctx[1:], w)

    for n in range(2, order + 1):
        for ctx in [*after[n], ("never seen",) * (n - 1)]:
            assert abs(sum(p(ctx, w) for w in uni) + p(ctx, "unknown word") - 1) < 1e-9
    return [sum(math.log10(p(before(d_, i, order), w)) for i, w in enumerate(d_)) for d_ in docs]


def test_katz_matches_brute_force_and_sums_to_one(spark, docs_of):
    from pyspark.sql import functions as F

    random.seed(4)
    words = ["The", "the", "of", "a", "é", "cat", "dog", "ran", "sat", "on", "mat", "x1", "y"]
    texts = [" ".join(random.choices(words, range(len(words), 0, -1), k=random.randrange(0, 40))) for _ in range(60)] + [None, "", "new words only"]
    train = [k % 3 != 0 for k in range(len(texts))]
    docs = docs_of([(k, t, "en") for k, t in enumerate(texts)])
    for order in (2, 3):
        got = {r["doc_id"]: r for r in katz.score(docs, F.col("doc_id") % 3 != 0, order=order, block_tokens=100, partition_tokens=50).collect()}
        want = katz_brute(texts, train, order)
        assert len(got) == len(texts) and all(abs(got[k]["score"] - want[k]) < 1e-8 for k in got)


def test_katz_trigrams_beat_unigrams_and_are_finite(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(k, "the cat sat on the mat . the dog ran home ." if k % 2 else "a bird sings on a tree . a fish swims .", "en") for k in range(30)])
    rows = katz.score(docs, F.col("doc_id") > 5, order=3).collect()
    assert all(r["score"] > r["base_score"] and math.isfinite(r["score"]) for r in rows)


def test_katz_learns_nothing(spark, docs_of):
    from pyspark.sql import functions as F

    r = katz.score(docs_of([(1, "a b", "en")]), F.lit(False)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["score"], r["base_score"]) == (3, 0, 0, 0.0, 0.0)


def test_language_accuracy_on_held_out_rows(spark, docs_of):
    random.seed(6)
    parts = {"en": ["the", "ing", "tion", "and", "er", "th"], "fr": ["eau", "eux", "ment", "la", "é", "ou"], "de": ["sch", "und", "ung", "ein", "ß", "ich"]}
    rows = [(k, " ".join("".join(random.choices(parts[lang], k=2)) for _ in range(random.randrange(3, 60))), lang) for k in range(300) for lang in [random.choice(list(parts))]]
    docs = docs_of(rows)
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    model = language_id.fit(docs, training=~language_id.held_out())
    got = language_id.identify(docs, model).collect()
    test = [r for r in got if held(r["doc_id"])]
    assert len(test) > 40 and np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got) and sum(r["rejected"] for r in got) <= 3
    far = language_id.identify(docs_of([(1, "Καλημέρα κόσμε πώς είσαι", "el"), (2, "12 !", None)]), model).collect()
    assert all(r["rejected"] for r in far) and far[1]["lang_pred"] == "und"


def test_language_keeps_several_centroids_and_rejects_other_languages(spark, docs_of):
    random.seed(8)
    parts = {"en": [["the", "ing", "and"], ["tion", "ou", "sh"], ["wh", "er", "st"]], "fr": [["eau", "eux", "la"], ["ment", "ai", "qu"], ["é", "ou", "oi"]]}
    rows = [(k, " ".join("".join(random.choices(parts[lang][k % 3], k=2)) for _ in range(random.randrange(20, 60))), lang) for k in range(480) for lang in [("en", "fr")[k // 240]]]
    rows += [(1000 + k, "Licensed under " + "zq" * k + " 4.0", lang) for k, lang in enumerate(("en", "fr") * 2)]
    model = language_id.fit(docs_of(rows), clusters=3)
    assert Counter(model.languages) == {"en": 3, "fr": 3}
    far = ["Dzisiaj rano poszedłem do sklepu, ponieważ chciałem kupić świeży chleb", "Tänään aamulla menin kauppaan ostamaan tuoretta leipää", "xqzv kjwpt bgfhd zzqrx mwvkl pqjxn tgbvf rfxzc"]
    got = language_id.identify(docs_of([*rows[:480], *((2000 + k, t, None) for k, t in enumerate(far))]), model).collect()
    assert all(r["rejected"] for r in got if r["doc_id"] >= 2000)
    assert sum(r["rejected"] for r in got if r["doc_id"] < 2000) <= 5


def test_language_sample_is_bounded(spark, docs_of):
    docs = docs_of([(k, f"some words {k}", "en") for k in range(500)] + [(1, "repeated row", "en")] * 300)
    assert len(language_id.fit(docs, sample_per_language=20, clusters=3, dims=256).languages) <= 3


def test_rejection_limits_keep_own_rows_and_shrink_for_short_texts():
    own, other = np.linspace(0.5, 0.9, 101), np.linspace(0.1, 0.3, 101)
    assert abs(language_id._limit(own, other) - (0.504 + 0.2) / 2) < 1e-9
    assert language_id._limit(own, own + 0.3) <= np.quantile(own, 0.01)
    assert language_id._limit(own[:0], other[:0]) == 0 and language_id._limit(own, other[:0]) < 0.504
    assert list(language_id._room(np.array([0, 16, 64, 500]))) == [0.125, 0.5, 1, 1]
