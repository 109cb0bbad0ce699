import pytest
from pyspark.sql import functions as F

from leafmill.operators import binding, facts, planning, quality, render, reports, structure
from leafmill.sources import inbox


def read(spark, text, caption=""):
    rows = spark.createDataFrame([(1, text, caption)], "figure_id int, text string, caption string")
    return [(r["type"], tuple(r["entities"]), r["evidence"], r["review_state"]) for r in facts.relations(rows).orderBy("ord").collect()]


def test_points_and_segments(spark):
    def one(text):
        r = spark.createDataFrame([(text,)], "t string").select(facts.points(F.col("t")).alias("p")).select("p", facts.segments(F.lit(text), F.col("p")).alias("s")).first()
        return r["p"], r["s"]

    assert one("A B C A D B")[0] == ["A", "B", "C", "D"]
    assert set(one(r"in $\triangle ABC$ , $D$ on $AB$")[0]) == {"A", "B", "C", "D"}
    assert one(r"AB then \triangle{P Q R} and \angle{X Y Z}")[0] == ["P", "Q", "R", "X", "Y", "Z", "A", "B"]
    assert one("AB = CD, EF unknown, AD, AA")[1] == ["AB", "CD", "EF", "AD"]
    assert one(r"\overline{A B} and \overrightarrow{CD}, AB与")[1] == ["AB", "CD"]
    assert one("AB 垂直 CD 且 AB=CD") == (["A", "B", "C", "D"], ["AB", "CD"])


def test_relations_and_evidence(spark):
    assert read(spark, r"$\triangle ABC$, AB $\parallel$ CD") == [("parallel", ("AB",), "problem_text", "unreviewed"), ("parallel", ("CD",), "problem_text", "unreviewed")]
    assert {r[2] for r in read(spark, "说明三角形 ABC", "AB ∥ CD")} == {"diagram_mark"}
    assert {r[2] for r in read(spark, "AB // CD", "AB // CD (highlighted)")} == {"problem_text_and_diagram_mark"}
    assert [r[1] for r in read(spark, "M 是 AB 的中点")] == [("AB",), ("AB", "M")]
    assert [r[1] for r in read(spark, "∠ A B C")] == [("A", "B", "C"), ("A", "C", "C"), ("B", "C", "C")] or ("A", "C", "C") in [r[1] for r in read(spark, "∠ A B C")]
    rows = spark.createDataFrame([(1, "平行 only", ""), (2, "AB ∥ CD", "")], "figure_id int, text string, caption string")
    assert [r["figure_id"] for r in facts.observations(rows).collect()] == [1]


RELS = [(1, "parallel", ["AB", "CD"], "problem_text", "unreviewed"), (1, "midpoint", ["M"], "visual_inference", "unreviewed"), (2, "parallel", ["EF"], "unknown", "unreviewed")]


def decided(spark, decisions):
    rels = spark.createDataFrame(RELS, "figure_id int, type string, entities array<string>, evidence string, review_state string")
    rows = [(f, k, a, names, note, i) for i, (f, k, a, names, note) in enumerate(decisions)]
    said = spark.createDataFrame(rows, "figure_id int, key string, action string, corrected_entities array<string>, note string, ord int")
    return {(r["figure_id"], r["key"]): (r["review_state"], r["review_note"]) for r in facts.apply_decisions(rels, said).collect()}


def test_decisions_in_order(spark):
    got = decided(spark, [(1, "parallel::ab+cd", "confirm", None, None), (1, "parallel::ab+cd", "correct", ["AB", "XY"], "typo"), (1, "parallel::ab+xy", "reject", None, None), (1, "midpoint::m", "reject", None, "no")])
    assert got == {(1, "parallel::ab+xy"): ("rejected", "typo"), (1, "midpoint::m"): ("rejected", "no"), (2, "parallel::ef"): ("unreviewed", None)}


@pytest.mark.parametrize("bad", [(1, "parallel::zz", "reject", None, None), (9, "parallel::ab+cd", "reject", None, None), (1, "midpoint::m", "confirm", None, None)])
def test_decisions_that_fail(spark, bad):
    with pytest.raises(Exception, match="unknown relation|cannot confirm"):
        decided(spark, [bad])


def test_audit_keeps_the_last(spark):
    schema = "figure_id int, key string, action string, ord int"
    old, new = spark.createDataFrame([(1, "a", "confirm", 5), (2, "b", "reject", 1)], schema), spark.createDataFrame([(1, "a", "reject", 0), (1, "c", "confirm", 1)], schema)
    assert [tuple(r)[:3] for r in facts.audit(old, new).collect()] == [(1, "a", "reject"), (1, "c", "confirm"), (2, "b", "reject")]


def test_quota_rules(spark):
    rows = [("t", 900, 200, "REFUSE_PRE"), ("t", 100, 200, "ALLOW"), ("t", 100, None, "WARN_LIVE"), ("t", 1000, None, "REFUSE_PRE"), ("y", 1000, 200, "ALLOW"), ("t", 1000, 0, "ALLOW"), ("y", 5, 1001, "REFUSE_PRE")]
    df = spark.createDataFrame(rows, "day string, used int, est int, want string")
    got = df.select("want", quality.quota_decision(F.col("day"), F.lit("t"), F.col("used"), F.lit(1000), F.col("est")).alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got)


def test_blocks_contained_in_items(spark):
    items = spark.createDataFrame([(1, 1, "i1", "alpha beta gamma. delta", "c"), (1, 2, "i2", "alpha beta", "c"), (1, 3, "i3", "epsilon", "d")], "doc_id long, item_seq int, item_id string, text string, chapter string")
    blocks = spark.createDataFrame([(1, "b1", "paragraph", None, "alpha **beta**", 5, 0, 1), (1, "b2", "paragraph", None, "gamma. delta", 7, 0, 1), (1, "b3", "paragraph", None, "epsilon zeta", 9, 0, 1), (1, "b4", "paragraph", None, "alpha", 3, None, None)], "doc_id long, block_id string, block_type string, heading_level int, text string, source_line_start int, page_index int, page_number int")
    got = [tuple(r) for r in binding.contained_blocks(items, binding.synthetic_blocks(blocks)).orderBy("item_id", "n").collect()]
    assert got == [(1, "i1", 0, "b2"), (1, "i1", 1, "b1"), (1, "i3", 0, "b3")]


def test_images_by_path_then_stem(spark):
    md = spark.createDataFrame([(1, "images/a.png", 1), (1, "other/a.jpg", 2), (1, "./images/a.png", 3), (1, "b.png", 4)], "doc_id long, target string, line_no int")
    lay = spark.createDataFrame([(1, "images/a.png", None, "v1", 0, 0), (1, "x/a.gif", None, "v2", 0, 1), (1, "y/a.gif", None, "v3", 1, 0), (1, None, "b", "v4", 2, 0)], "doc_id long, path string, asset_id string, block_id string, page_index int, block_order int")
    assert sorted(tuple(r)[1:] for r in structure.paired_images_or_stems(md, lay).collect()) == [(1, "v1"), (2, "v2"), (3, "v3"), (4, "v4")]


def test_planner(spark):
    items = spark.createDataFrame([("i1", "example", 1, "Some title", "Some title text", [3]), ("i2", "definition", 2, "Other title", "body", []), ("i3", "chapter", 3, "Chapter one", "x", []), ("i4", "other", 4, "118", "118 left", [9]), ("i5", "other", 5, "8-2", "", [])], "item_id string, item_type string, item_seq int, title string, text string, pages array<int>")
    scores = spark.createDataFrame([("i1", "t1", 3), ("i1", "t2", 1), ("i2", "t1", 2)], "item_id string, topic_id string, score int")
    assets = spark.createDataFrame([("i4", "f4"), ("i2", "f2"), ("i2", "f1")], "item_id string, asset_id string")
    got = planning.plan(items, scores, assets, spark.createDataFrame([("f4",)], "asset_id string"))
    assert [tuple(r) for r in got["plans"].orderBy("plan_seq", "pos").select("topic_id", "pos", "item_id").collect()] == [("t1", 1, "i2"), ("t1", 2, "i1"), ("_misc", 1, "i4")]
    assert {(r["item_id"], r["title"], r["text"]) for r in got["items"].filter("reason is not null").collect()} == {("i4", "内容图（源页 9）", "left")}
    assert {r["topic_id"]: set(r["names"]) for r in got["figures"].collect()} == {"t1": {"f1", "f2"}, "_misc": {"f4"}}


def test_handles_and_reports(spark, tmp_path):
    at = str(tmp_path / "x/handle.json")
    assert inbox.load_handle(at) is None
    inbox.save_handle(at, {"task": "t", "n": 1})
    assert inbox.load_handle(at) == {"task": "t", "n": 1}
    inbox.clear_handle(at)
    assert inbox.load_handle(at) is None
    report = spark.createDataFrame([(1,)], "n int")
    reports.write_once(report, str(tmp_path / "r"))
    with pytest.raises(Exception, match="(?i)exist"):
        reports.write_once(report, str(tmp_path / "r"))
    log = spark.createDataFrame([(1, "a")], "figure_id int, key string")
    reports.saved_queue(str(tmp_path / "q"), report, log, force=True)
    assert spark.read.schema("figure_id int, key string").json(str(tmp_path / "q/decisions")).count() == 0
    files = spark.createDataFrame([("t", "imgs/a.png"), ("t", "image/b.png"), ("u", "full.md")], "task_id string, path string")
    assert [tuple(r) for r in inbox.image_folder(files).collect()] == [("t", "image")]


def test_long_lines_of_a_pdf_are_broken():
    words = " ".join(f"word{k}" for k in range(60))
    pdf = render.pdf_bytes([("body", words)], "t")
    assert all(f"word{k}".encode() in pdf for k in range(60))


def test_headings_of_any_level(spark):
    rows = [(1, 0, i, f"b{i}", "heading" if lv else "text", lv, None, "t") for i, lv in enumerate([7, None, 9, 8, None])]
    got = structure.heading_parents(spark.createDataFrame(rows, "doc_id long, page_index int, block_order int, block_id string, type string, level int, bbox array<double>, text string"))
    assert {r["block_id"]: r["parent_id"] for r in got.collect()} == {"b1": "b0", "b2": "b0", "b3": "b0", "b4": "b3"}
