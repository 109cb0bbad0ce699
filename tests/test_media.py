import random
import time

from leafmill.operators import media


def test_clusters_of_a_long_chain(spark):
    nodes = spark.createDataFrame([(k,) for k in range(140)], "id long")
    chain = [(k, k + 1) for k in range(119)]
    pairs = spark.createDataFrame([*chain, (130, 131)], "a long, b long")
    got = {r["id"]: r["cluster"] for r in media.clusters(nodes, "id", pairs).collect()}
    assert got == {k: 0 if k < 120 else 130 if k == 131 else k for k in range(140)}


def test_clusters_of_a_very_long_chain(spark):
    n = 10_000
    nodes = spark.range(n + 2)
    pairs = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b")
    got = media.clusters(nodes, "id", pairs).groupBy("cluster").count().collect()
    assert {r["cluster"]: r["count"] for r in got} == {0: n, n: 1, n + 1: 1}


def test_nearest_references_equal_brute_force(spark):
    random.seed(3)
    base = [[random.getrandbits(63) for _ in range(4)] for _ in range(3)]
    near = lambda x, n: [w ^ sum(1 << b for b in random.sample(range(62), n // 4)) for w in x]
    hashes = [(k, near(base[k % 3], random.choice([0, 4, 8, 16, 20]))) for k in range(60)]
    refs = [(f"r{k}", b) for k, b in enumerate(base)]
    far = lambda x, y: sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True))
    want = {(r, i, d, n + 1) for r, b in refs for n, (d, i) in enumerate(sorted((far(x, b), i) for i, x in hashes if far(x, b) <= 18)[:5])}
    got = media.nearest_references(spark.createDataFrame(hashes, "id int, bits array<long>"), spark.createDataFrame(refs, "ref_id string, ref_bits array<long>"), top=5)
    assert {tuple(r) for r in got.collect()} == want and len(want) == 15


def test_holding_equals_brute_force(spark):
    random.seed(5)
    word = lambda n: "".join(random.choice("aé\n😀") for _ in range(n))
    texts = [(k, word(n)) for k, n in enumerate([0, 1, 2, 3, 5, 40, 90, 90, 300, 700])] + [(10, None), (8, "a" * 70)]
    cut = lambda t, n: t[(i := random.randrange(len(t) - n + 1)) : i + n]
    phrases = [(100 + n, cut(texts[9][1], n)) for n in (1, 2, 3, 4, 6, 7, 31, 62, 63, 64, 100, 500, 700)] + [(900, "a" * 63), (901, "a" * 63), (902, texts[5][1]), (903, "a" * 71), (904, None), (905, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    met = media.holding(docs, spark.createDataFrame(phrases, "item_id long, phrase string"), "text", "phrase")
    got = sorted((r["doc_id"], r["item_id"], r["text"], r["phrase"]) for r in met.collect())
    assert got == sorted((d, i, t, p) for d, t in texts for i, p in phrases if t is not None and p is not None and p in t)
    assert (8, 905, "a" * 70, "") in got


def test_holding_takes_linear_time_in_a_text(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "concat(repeat('some words é of no phrase at all ', 60000), 'the phrase that is looked for') AS text")
    phrases = spark.createDataFrame([(1, "the phrase that is looked for"), (2, "the phrase that is looked at")], "item_id long, phrase string")
    start = time.monotonic()
    assert [r["item_id"] for r in media.holding(docs, phrases, "text", "phrase").collect()] == [1]
    assert time.monotonic() - start < 60


def test_near_forest_connects_what_all_pairs_connect(spark):
    random.seed(11)
    signed = lambda n: n - (1 << 64) if n >= 1 << 63 else n
    base = [[random.getrandbits(64) for _ in range(2)] for _ in range(6)]
    flips = lambda x: [w ^ sum(1 << b for b in random.sample(range(64), random.choice([0, 3, 9]))) for w in x]
    raw = [flips(random.choice(base)) for _ in range(150)] + [base[0]] * 20
    hashes = spark.createDataFrame([(k, [signed(w) for w in x]) for k, x in enumerate(raw)], "id long, bits array<long>")
    for block in (7, 1000):
        got = media.near_forest(hashes, "id", "bits", 12, words=2, block=block)
        pairs = media.hamming_pairs(hashes, "id", "bits", 12, words=2)
        label = lambda edges: {r["id"]: r["cluster"] for r in media.clusters(hashes, "id", edges).collect()}
        assert label(got) == label(pairs)
        assert block < 1000 or got.count() < len(raw) < pairs.count()
