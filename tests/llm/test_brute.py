"""Whole results against plain loops over small tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import decontaminate, language_id, near_dedup, packing, pii, secret_scan, sharding
from test_spans import digits, pii_brute, secrets_brute


def extension(agrees):
    score = best = length = 0
    for at, a in enumerate(agrees, 1):
        score += 1 if a else -3
        if score > best:
            best, length = score, at
    return length


def overlaps(docs, items, reach=64, min_share=0.5, min_run=13, band=8):
    words = lambda t: regex.sub(r"[^\p{L}\p{N}]+", " ", (t or "").lower()).split()
    out = set()
    for item_id, body in items:
        b = words(body)
        n = len(b)
        masks = [*decontaminate.MASKS] if n >= max(map(len, decontaminate.MASKS)) else [*decontaminate.MASKS, "1" * n]
        for doc_id, text in docs:
            w, pairs = words(text), set()
            for m in masks:
                ones = [k for k, c in enumerate(m) if c == "1"]
                pairs |= {(i, j) for j in range(n - len(m) + 1) for i in range(len(w) - len(m) + 1) if n and all(w[i + k] == b[j + k] for k in ones)}
            runs, shares = set(), set()
            for i, j in pairs:
                left, low, high = max(0, i - reach), max(0, j - reach), min(n, j + reach)
                agrees = [left <= i - j + p < min(len(w), left + 2 * reach) and w[i - j + p] == b[p] for p in range(low, high)]
                here = j - low
                start, end = j - extension(agrees[:here][::-1]), j + extension(agrees[here:])
                runs.add((i - j, tuple(p for p in range(start, end) if agrees[p - low])))
                shares.add((sum(agrees) / len(agrees), sum(agrees)))
            if runs:
                together = max(len({p for line, run in runs if abs(line - at) <= band for p in run}) for at, _ in runs)
                share, along = max(shares)
                if max(len(r) for _, r in runs) >= min_run or together >= n * min_share or share >= min_share:
                    out.add((doc_id, item_id, max(together, along), n))
    return out


def leak_corpus(seed):
    random.seed(seed)
    words = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(random.choices(words, k=random.choice([1, 2, 4, 5, 7, 9, 10, 14, 30, 80, 150])))) for k in range(14)] + [(50, None), (51, "")]
    docs = []
    for i in range(40):
        body = random.choices(words, k=random.choice([0, 3, 30, 120]))
        if i % 3:
            b = items[i % 14][1].split()
            cut = random.randrange(len(b))
            b = random.choice([b, b[cut:], b[:cut], b[: cut // 2] + ["new"] + b[cut // 2 :], [x if random.random() > 0.15 else "changed" for x in b]])
            body[len(body) // 2 : len(body) // 2] = b
        docs.append((i, " ".join(body)))
    return [*docs, (90, None), (91, docs[1][1]), (92, "Ünïcode … " + items[3][1].upper())], items


def test_overlaps_equal_brute_force(spark, docs_of):
    docs, items = leak_corpus(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = overlaps(docs, items)
    for options in ({}, {"max_seeds": 1}):
        got = decontaminate.find_overlaps(docs_of([(i, t, "en") for i, t in docs]), benchmark, **options)
        assert {tuple(r) for r in got.select("doc_id", "item_id", "matched", "compared").collect()} == want
    assert len(want) > 20 and any(n < 5 for *_, n in want)


def term_spans(texts, support=3, at_least=0.7):
    words = lambda t: {x for x in regex.split(r"[^\p{L}\p{N}]+", t) if regex.fullmatch(r"\p{L}{2,}", x)}
    rows = []
    for t in texts:
        t = t or ""
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in pii_brute(t))]
        bare = list(t)
        for _, s, e in spans:
            bare[s:e] = " " * (e - s)
        entity = lambda k, v: f"{k}:{v.lower() if k == 'email' else v if k == 'ip' else digits(v)}"
        rows.append((t, spans, "".join(bare), {entity(k, t[s:e]) for k, s, e in spans}))
    n, n_t, n_c, n_tc = len(rows), Counter(), Counter(), Counter()
    for t, spans, bare, entities in rows:
        n_t.update({w.lower() for w in words(t)} | ({w.lower() for w in words(bare)} if spans else set()))
        n_c.update(entities)
        n_tc.update((c, w) for c in entities for w in {x.lower() for x in words(bare)})
    told = {(c, w) for (c, w), x in n_tc.items() if (x >= support or x == n_t[w]) and n_c[c] < n and math.log(n * x / (n_t[w] * n_c[c])) / math.log(n / n_c[c]) >= at_least}
    out = []
    for _, spans, bare, entities in rows:
        terms = [m for m in regex.finditer(r"(?<![\p{L}\p{N}])\p{L}{2,}(?![\p{L}\p{N}])", bare) if any((c, m[0].lower()) in told for c in entities)] if spans else []
        out.append(",".join([f"{k}:{s}:{e}" for k, s, e in spans] + [f"term:{m.start()}:{m.end()}" for m in terms]))
    return out


def test_all_personal_spans_equal_brute_force(spark, folder_of):
    random.seed(12)
    words = ["plan", "river", "Oslo", "Marlowe", "box", "naïve", "über", "the", "of", "a", "x1", "Plan", "city"]
    marks = ["a@b.co", "A@b.co", "1.2.3.4", "+1 (555) 123-4567", "4539148803436467"]
    texts = [" ".join(random.choices(words, k=random.randrange(0, 12)) + random.choices(marks, k=random.choice([0, 0, 1, 2])) + random.choices(words, k=random.randrange(0, 5))) for _ in range(70)]
    texts += [None, "", texts[3], texts[3], "abc1.2.3.4 rare", "Secretword a@b.co, Secretword; secretWord"]
    got = {r["doc_id"]: r["spans"] for r in pii.op6(spark, folder_of([(k, t, "en") for k, t in enumerate(texts)])).collect()}
    want = dict(enumerate(term_spans(texts)))
    assert got == want and sum("term" in s for s in want.values()) >= 2


def test_ring_places_equal_a_walk(spark, docs_of):
    rows = docs_of([(k // 3, f"t{k}", "en") for k in range(240)] + [(None, f"n{k}", "en") for k in range(60)] + [(7, "same", "en")] * 30)
    shards, points, cells = 5, 64, 4
    got = sharding.shard_rows(rows, "doc_id", ["doc_id", "text"], shards=shards, vnodes=3, points=points, cells=cells).collect()
    arc = F.pmod(F.xxhash64(F.lit("key"), "doc_id"), F.lit(points))
    line = rows.select("doc_id", "text", arc.alias("arc"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(cells)).alias("cell")).collect()
    line.sort(key=lambda r: (r["arc"], r["cell"], r["doc_id"] is not None, r["doc_id"], r["text"]) if r["doc_id"] is not None else (r["arc"], r["cell"], False, 0, r["text"]))
    owners = sharding.ring_owners(spark, shards, 3, points)
    room, filled, want = [len(line) // shards + (s < len(line) % shards) for s in range(shards)], [0] * shards, Counter()
    for r in line:
        p = r["arc"]
        while filled[owners[p]] == room[owners[p]]:
            p = (p + 1) % points
        want[r["doc_id"], r["text"], owners[p], filled[owners[p]]] += 1
        filled[owners[p]] += 1
    assert Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in got) == want


def test_ring_moves_few_rows(spark, docs_of):
    rows = docs_of([(k, "x", "en") for k in range(4000)])
    where = lambda n: {r["doc_id"]: r["shard"] for r in sharding.shard_rows(rows, "doc_id", ["doc_id"], shards=n).collect()}
    one, two = where(40), where(41)
    moved = sum(one[k] != two[k] for k in one) / len(one)
    assert moved < 0.35 and max(Counter(two.values()).values()) - min(Counter(two.values()).values()) <= 1


@pytest.mark.parametrize("names", [("doc_id", "n"), ("bucket", "place"), ("arc", "cnt"), ("_k1", "start"), ("shard", "rank")])
def test_any_key_names(spark, names):
    rows = spark.range(50).select(F.col("id").alias(names[0]), (F.col("id") % 7 + 1).alias(names[1]))
    assert packing.pack(rows, names[1], list(names)).count() == 50
    assert sharding.shard_rows(rows, names[0], list(names), shards=3).count() == 50


def test_padding_is_optimal_and_limits_are_lengths_of_rows(spark, docs_of):
    random.seed(2)
    lengths = [random.choice([1, 2, 3, 30, 31, 90]) + random.randrange(4) for _ in range(80)] + [700, 5000, 5001]
    docs = docs_of([(k, "w " * (n - 1), "en") for k, n in enumerate(lengths)])
    rows = packing.pack_documents(docs, buckets=4).collect()
    xs = sorted(set(lengths))
    cost = {0: 0}
    for _ in range(4):  # at most four limits
        cost = {j: min(cost[i] + sum(xs[j - 1] - n for n in lengths if (xs[i - 1] if i else 0) < n <= xs[j - 1]) for i in cost if i <= j) for j in range(len(xs) + 1)}
    assert sum(r["bucket_len"] - r["n_tokens"] for r in rows) == cost[len(xs)]
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == dict(enumerate(lengths))
    tops = defaultdict(int)
    for r in rows:
        tops[r["bucket"]] = max(tops[r["bucket"]], r["n_tokens"])
    assert all(tops[r["bucket"]] == r["bucket_len"] for r in rows)


def identified(text, model):
    """(language, cosine, rejected) by counting trigrams one by one."""
    if not text or not any(map(str.isalpha, text)):
        return "und", 0.0, True
    raw = " " + "".join(chr(x) if 97 <= x < 123 or x >= 128 else " " for x in f" {text.lower()} ".encode()).strip() + " "
    raw = re.sub(" +", " ", raw)
    dims = len(model.idf)
    shift = 32 - (dims - 1).bit_length()
    grams = Counter(((ord(a) << 16 | ord(b) << 8 | ord(c)) * 2654435769 % 2**32) >> shift for a, b, c in zip(raw, raw[1:], raw[2:], strict=False))
    x = {g: math.log1p(n) * float(model.idf[g]) for g, n in grams.items()}
    norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
    cosines = [sum(v / norm * float(c[g]) for g, v in x.items()) for c in model.centroids]
    at = max(range(len(cosines)), key=lambda i: (cosines[i], -i))
    return model.languages[at], cosines[at], cosines[at] < model.limits[at] * min(1, (max(len(x), 1) / 64) ** 0.5)


def language_rows(n, seed):
    random.seed(seed)
    parts = {"en": ["the", "ing", "tion", "and", "er"], "fr": ["eau", "eux", "ment", "la", "é"], "de": ["sch", "und", "ung", "ein", "ß"]}
    return [(k, " ".join("".join(random.choices(parts[lang], k=2)) for _ in range(random.randrange(5, 60))), lang) for k in range(n) for lang in [random.choice(list(parts))]]


def test_languages_equal_brute_force(spark, docs_of):
    rows = language_rows(200, 1)
    model = language_id.fit(docs_of(rows), training=~language_id.held_out())
    odd = [(900, None, None), (901, "", None), (902, "12 ! 3", None), (903, "Καλημέρα κόσμε", None), (904, "Tänään aamulla menin kauppaan", None), (905, "a", None), (906, "x" * 5000, None)]
    for r in language_id.identify(docs_of(rows + odd), model).collect():
        lang, score, rejected = identified(r["text"], model)
        assert (r["lang_pred"], r["rejected"]) == (lang, rejected) and abs(r["score"] - min(1, max(0, score))) < 1e-4


def test_language_model_does_not_depend_on_the_order_of_rows(spark, docs_of):
    rows = language_rows(300, 2)
    rows += [(k, t[::-1], lang) for k, t, lang in rows[:120]]  # ids that come twice
    one, two = language_id.fit(docs_of(rows), sample_per_language=40), language_id.fit(docs_of(rows[::-1]).repartition(7), sample_per_language=40)
    assert one.languages == two.languages and np.allclose(one.centroids, two.centroids) and np.allclose(one.limits, two.limits)


def classes_brute(texts):
    sh = {i: near_dedup.shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in texts:
        for j in texts:
            if j < i and (texts[i] == texts[j] or near_dedup.similarity(sh[i], sh[j]) >= 0.8):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_every_shared_bucket_pair_can_be_verified(spark, docs_of):
    random.seed(21)
    words = [f"w{k}" for k in range(500)]
    base = [random.choices(words, k=120) for _ in range(6)]
    texts = {}
    for i in range(60):
        t = list(base[i % 6])
        for _ in range(random.choice([0, 1, 2, 3, 5])):
            t[random.randrange(120)] = random.choice(words)
        texts[i] = " ".join(t)
    docs = docs_of([(i, t, "en") for i, t in texts.items()])
    want = classes_brute(texts)
    for compare in (True, False):
        assert {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs, compare_sketches=compare).collect()} == want


def test_recall_by_similarity(spark, docs_of):
    """Pairs of texts by themselves, so that no third text connects them."""
    random.seed(31)
    rows, sims = [], {}
    for pair in range(500):
        a = [f"p{pair}w{k}" for k in range(random.choice([60, 150, 400]))]
        b = list(a)
        for at in random.sample(range(len(b)), max(1, round(len(b) * random.uniform(0.005, 0.026)))):
            b[at] = "other" + str(random.random())
        texts = [" ".join(a), " ".join(b)]
        sims[pair] = near_dedup.similarity(*map(near_dedup.shingles, texts))
        rows += [(2 * pair + k, t, "en") for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs_of(rows)).collect()}
    found = {pair: got[2 * pair + 1] == 2 * pair for pair in sims}
    table = {low: [found[p] for p, s in sims.items() if low <= s < high] for low, high in ((0.8, 0.82), (0.82, 0.85), (0.85, 0.9), (0.9, 1.01))}
    print({low: (len(x), sum(x)) for low, x in table.items()})
    assert all(len(x) >= 20 and sum(x) >= 0.97 * len(x) for x in table.values())
    assert not any(found[p] for p, s in sims.items() if s < 0.8)


def test_pipeline_equals_brute_force(spark, folder_of):
    rows = language_rows(160, 5)
    random.seed(6)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    rows += [(1000 + k, rows[k][1] + random.choice(["", " und", " the end"]), rows[k][2]) for k in range(40)]
    rows += [(2000 + k, f"{rows[k][1]} {item} {rows[k + 1][1]}", rows[k][2]) for k in range(5)]
    rows += [(3000 + k, f"{rows[k + 60][1]} password=abcdef{k}0123456789abcdef {rows[k + 70][1]}", rows[k][2]) for k in range(5)]
    rows += [(4000, None, "en"), (4001, "", None), (4002, "Dzisiaj rano poszedłem do sklepu ponieważ chciałem", None), (4003, "12 34", "en")]
    d = folder_of(rows, [(1, item)])
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = language_id.fit(docs, training=~language_id.held_out())
    texts = {i: t for i, t, _ in rows if t is not None and not identified(t, model)[2]}
    texts = {i: texts[i] for i, c in classes_brute(texts).items() if i == c}
    leaks = {i for i, *_ in overlaps(texts.items(), [(1, item)])}
    texts = {i: secret_scan.redact_text(t, secrets_brute(t), corpus_pipeline.SECRET_MARK) for i, t in texts.items() if i not in leaks}
    want = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1 for i, t in texts.items()}
    got = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(want)
    assert len(leaks) == 5 and sum(corpus_pipeline.SECRET_MARK in t for t in texts.values()) == 5 and 150 < len(want) < 190
    for r in got:
        assert r["n_tokens"] <= r["bucket_len"]
