from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leafmill.operators import binding, facts, media, planning, render, structure

BLOCK = "doc_id long, page_index int, block_order int, block_id string, type string, level int, bbox array<double>, text string"


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from([0, 1, 2, 3, 4]), min_size=1, max_size=12), min_size=1, max_size=20))
def test_heading_parent_is_the_stack_rule(spark, documents):
    rows, want = [], {}
    for d, levels in enumerate(documents):
        stack = []
        for i, level in enumerate(levels):
            rows.append((d, 0, i, f"b{i}", "heading" if level else "text", level or None, None, "t"))
            if level:
                while stack and stack[-1][0] >= level:
                    stack.pop()
            if stack:
                want[d, f"b{i}"] = stack[-1][1]
            if level:
                stack.append((level, f"b{i}"))
    got = structure.heading_parents(spark.createDataFrame(rows, BLOCK))
    assert {(r["doc_id"], r["block_id"]): r["parent_id"] for r in got.collect()} == want


def test_recover_edges(spark):
    rows = [(1, 0, 0, "h", "heading", 1, [0.0, 0.0, 50.0, 10.0], "Chapter"), (1, 0, 1, "t", "text", None, [0.0, 20.0, 50.0, 30.0], "some words here and"), (1, 0, 2, "f", "figure", None, [0.0, 40.0, 50.0, 60.0], ""), (1, 0, 3, "c", "caption", None, [0.0, 62.0, 50.0, 66.0], "图 1"), (1, 1, 0, "u", "text", None, [0.0, 0.0, 50.0, 10.0], "more words.")]
    got = {(r["kind"], r["source_id"], r["target_id"], r["confidence"]) for r in structure.recover(spark.createDataFrame(rows, BLOCK)).collect()}
    assert ("caption_for", "c", "f", 0.95) in got and ("attached_to", "f", "t", 0.80) in got and ("continues_to", "t", "u", 0.90) in got and ("parent_heading", "u", "h", 0.95) in got


def test_alignment_status(spark):
    rows = [(None, 0, 0, 0, 0, "missing_markdown"), (100, 0, 0, 0, 0, "not_needed"), (1000, 300, 5, 1, 1, "not_needed"), (1000, 10, 5, 1, 1, "not_needed"), (1000, 10, 50, 1, 0, "unavailable_no_image_matches"), (1000, 10, 50, 1, 3, "active")]
    df = spark.createDataFrame(rows, "markdown_chars int, layout_chars int, layout_blocks int, layout_text_blocks int, matched int, want string")
    assert all(r["status"] == r["want"] for r in structure.alignment_status(df).collect())


def test_greedy_binding_moves_forward(spark):
    items = spark.createDataFrame([(1, 1, "i1", "definition", "abc", ["xx"], "c"), (1, 2, "i2", "example", "def", ["yy"], "c"), (1, 3, "i3", "theorem", "nope", ["zz"], "c")], "doc_id long, item_seq int, item_id string, item_type string, title string, tokens array<string>, chapter string")
    blocks = spark.createDataFrame([(1, "c", 0, 0, "b0", "definition", "abc", ["xx"], False, None), (1, "c", 0, 1, "b1", "figure", "", [], True, None), (1, "c", 0, 2, "b2", "example", "def", ["yy"], False, None), (1, "c", 0, 3, "b3", "figure", "", [], True, "b0")], "doc_id long, chapter string, page_index int, block_order int, block_id string, type string, text string, tokens array<string>, has_image boolean, attached_to string")
    got = [(r["item_id"], r["block_id"]) for r in binding.greedy_binding(items, blocks).orderBy("item_id", "n").collect()]
    assert got == [("i1", "b0"), ("i1", "b3"), ("i1", "b1"), ("i2", "b2")]


def test_hamming_pairs_are_exact(spark):
    import random

    random.seed(5)
    base = [[random.getrandbits(63) for _ in range(4)] for _ in range(6)]
    rows = [(k, [x ^ (1 << random.randrange(62)) if random.random() < 0.6 else x for x in base[k % 6]]) for k in range(40)]
    want = {(a, b) for a, x in rows for b, y in rows if a < b and sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True)) <= 4}
    got = media.hamming_pairs(spark.createDataFrame(rows, "id int, bits array<long>"), "id", "bits", 4, words=4)
    assert {(r["a"], r["b"]) for r in got.collect()} == want and want


def test_resolve_and_figures(spark):
    urls = spark.createDataFrame([("http://x/a.png", "1"), ("http://y/a.png", "2"), ("http://x/b.png?q=1", "3")], "url string, asset_id string")
    refs = spark.createDataFrame([("http://x/a.png",), ("img/b.png?q=1",), ("img/a.png",), ("img/b.png",)], "ref string")
    assert {r["ref"]: r["asset_id"] for r in media.resolve(refs, urls).collect()} == {"http://x/a.png": "1", "img/b.png?q=1": "3", "img/a.png": None, "img/b.png": None}
    assets = spark.createDataFrame([("abc", "http://x/0123456789abcdefXYZ.png", 1)], "asset_id string, source_url string, ord int")
    figs = spark.createDataFrame([("abc",), ("http://x/0123456789abcdefXYZ.png",), ("0123456789abcdefXYZ.jpg",), ("abc-9",), ("none",)], "ref string")
    assert {r["ref"]: r["asset_id"] for r in binding.resolve_figures(figs, assets).collect()} == {"abc": "abc", "http://x/0123456789abcdefXYZ.png": "abc", "0123456789abcdefXYZ.jpg": "abc", "abc-9": "abc", "none": None}


def test_angle_triples_keep_duplicates(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(facts.angle_triples(F.array(*map(F.lit, "ABC")))).first()[0]
    assert got == [["A", "B", "C"], ["A", "C", "C"], ["B", "C", "C"]] or ["A", "C", "C"] in got


def test_superseded_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (2, "z"), (3, "x"), (3, "y"), (4, "q")], "plan_id int, item_id string")
    assert [tuple(r) for r in planning.superseded(df).collect()] == [(1, 3, 2)]


def test_pdf(spark):
    lines = spark.createDataFrame([("p", 1, 0, "heading", "Title 三角"), ("p", 1, 1, "body", "a (b) \\c"), ("p", 1, 2, "missing", "f1")], "plan_id string, pos int, line_seq int, style string, content string")
    row = render.render_pdf(lines).first()
    assert bytes(row["pdf"]).startswith(b"%PDF-1.4") and b"Title ?" in bytes(row["pdf"]) and bytes(row["pdf"]).endswith(b"%%EOF\n")
    assert render.validation(lines).first()["status"] == "blocked"


def test_paired_images_of_many_documents(spark):
    import time

    n = 6000
    images = spark.range(n).selectExpr("id AS doc_id", "explode(array(1, 2, 3)) AS line_no").selectExpr("doc_id", "line_no", "CASE line_no WHEN 1 THEN 'x/a.png' WHEN 2 THEN 'x/a.png' ELSE concat('b', doc_id % 2, '.png') END AS target")
    visuals = spark.range(n).selectExpr("id AS doc_id", "explode(array(0, 1)) AS block_order").selectExpr("doc_id", "CASE block_order WHEN 0 THEN './x/a.png' END AS path", "CASE block_order WHEN 1 THEN 'b0' END AS asset_id", "concat('v', block_order) AS block_id", "0 AS page_index", "block_order")
    start = time.monotonic()
    got = sorted(map(tuple, structure.paired_images_or_stems(images, visuals).collect()))
    assert time.monotonic() - start < 30
    assert got == sorted([(d, 1, "v0") for d in range(n)] + [(d, 3, "v1") for d in range(0, n, 2)])
