import random

import numpy as np
from pyspark.sql import functions as F

from leafmill.llm import near_dedup
from leafmill.operators import graph


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2**63, 400, dtype=np.uint64)
    w = 1 + rng.random(400)
    for cut in (40, 150, 300):
        one, two = (np.sort(h[cut:]), None), (np.sort(h[: 400 - cut]), None)
        a = (one[0], w[cut:][np.argsort(h[cut:])])
        b = (two[0], w[: 400 - cut][np.argsort(h[: 400 - cut])])
        exact = near_dedup.similarity(a, b)
        brute = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {**x, **y}) for x, y in [(dict(zip(*map(list, a), strict=True)), dict(zip(*map(list, b), strict=True)))] for i in x if i in y)
        assert abs(exact - brute) < 1e-9
        s = np.mean(near_dedup.prob_minhash(*a, 4096) == near_dedup.prob_minhash(*b, 4096))
        assert abs(s - exact) < 4 * np.sqrt(exact * (1 - exact) / 4096) + 0.01


def test_equal_weights_give_the_plain_jaccard():
    a, b = np.arange(1, 101, dtype=np.uint64), np.arange(21, 121, dtype=np.uint64)
    assert abs(near_dedup.similarity((a, np.ones(100)), (b, np.ones(100))) - 80 / 120) < 1e-12


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(80), random.randrange(80)) for _ in range(60)] + [(100, k) for k in range(101, 140)] + [(k, k + 1) for k in range(200, 230)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want


def corpus():
    """Groups of copies with edits, some too far from each other, and texts that share a passage."""
    random.seed(11)
    words = [f"w{k}" for k in range(4000)]
    rows, k = [], 0
    shared = random.sample(words, 60)
    for group in range(6):
        base = random.sample(words, 150)
        for copy in range(12):
            t = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 3, 4, 6])):
                t[random.randrange(len(t))] = random.choice(words)
            rows.append((k, " ".join(t), "en"))
            k += 1
    for _ in range(40):
        rows.append((k, " ".join(random.sample(words, 60) + shared + random.sample(words, 60)), "en"))
        k += 1
    return [*rows, (k, rows[3][1], "en"), (k + 1, rows[3][1].upper() + "!", "en")]


def test_classes_match_brute_force(spark, docs_of):
    rows = corpus()
    sh = [near_dedup.shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if near_dedup.similarity(sh[i], sh[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs_of(rows)).collect()}
    assert got == {i: find(i) for i in range(len(rows))}
    kept = sorted(r["doc_id"] for r in near_dedup.keep_first(docs_of(rows)).collect())
    assert kept == sorted(set(got.values()))


def test_repeated_row_is_kept_once(spark, docs_of):
    docs = docs_of([(1, "a b c d e f g", "en"), (1, "a b c d e f g", "en"), (2, "a b c d e f g", "en"), (3, None, "en"), (3, None, "en")])
    assert sorted(r["doc_id"] for r in near_dedup.keep_first(docs).collect()) == [1, 3, 3]
