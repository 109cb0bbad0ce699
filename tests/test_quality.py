import itertools

from pyspark.sql import functions as F

from leafmill.operators import quality


def test_noise_rules(spark):
    rows = [("微信公众号 站", "x" * 50, "watermark"), ("118", "118", "number"), ("U", "U", "letter"), ("10", "10", "number"), ("8-2", "8-2", "page_range"), ("#", "", "symbol"), ("", "", "empty"), ("", "long enough", None), ("1234", "1234", None), ("A", "y" * 40, None), (None, None, "empty")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, title string, text string, want string")
    got = quality.partition_noise(df).orderBy("id").collect()
    assert [r["noise_reason"] for r in got] == [r[2] for r in rows]


def test_first_approved_matches_a_loop(spark):
    names = ["a", "b", "c"]
    for approved in itertools.chain.from_iterable(itertools.combinations(names, n) for n in range(4)):
        df = spark.createDataFrame(list(itertools.product([True, False], repeat=3)), "a boolean, b boolean, c boolean")
        cols = quality.first_approved([(n, F.col(n)) for n in names], approved)
        for r in df.select("*", *[c.alias("_" + k) for k, c in cols.items()]).collect():
            decision, fired, deferred = None, [], []
            for n in names:
                (fired if r[n] else deferred).append(n)
                if r[n] and n in approved:
                    decision = n
                    break
            assert (r["_decision"], r["_fired"], r["_deferred"]) == (decision, fired, deferred)


def test_asset_gate(spark):
    rows = [("a.png", True, 10, 5, 5, "png", None), ("a.txt", True, 10, 5, 5, "png", "suffix"), ("a.png", False, 0, 0, 0, None, "missing"), ("a.jpg", True, 10, 5, 5, "png", "suffix_differs"), ("a.png", True, 10, -1, -1, "png", "undecodable"), ("a.png", True, 20_000_000, 5, 5, "png", "too_many_bytes"), ("a.png", True, 10, 60000, 6000, "png", "too_many_pixels")]
    df = spark.createDataFrame(rows, "p string, e boolean, b int, w int, h int, m string, want string")
    for r in df.select("want", quality.asset_gate(*[F.col(c) for c in "pebwhm"]).alias("got")).collect():
        assert r["got"] == r["want"]


def test_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "k int, o int, v string")
    assert {(r["k"], r["v"]) for r in quality.latest(df, ["k"], [F.col("o")]).collect()} == {(1, "b"), (2, "c")}
