import json

import pytest
from pyspark.sql import functions as F

from leafmill.operators import binding, models, reports, structure
from leafmill.sources import cloud
from leafmill.tables import replace

PNG = bytes.fromhex("89504E470D0A1A0A")
CANDIDATE = "figure_id string, item_id string, asset_id string, path string, content binary, width int, height int, context string"


def no_cache(spark):
    return spark.createDataFrame([], "key string, role string, confidence double, reason string")


def test_equal_questions_are_asked_once_and_cached(spark, tmp_path):
    log = str(tmp_path / "calls")

    def provider(content, prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        return json.dumps({"role": "decor", "confidence": 0.7, "reason": "r"})

    rows = spark.createDataFrame([("f1", "i1", "a", "a.png", PNG, 9, 9, "c"), ("f2", "i2", "b", "b.png", PNG, 9, 9, "c"), ("f3", "i3", "a", "a.png", PNG, 9, 9, None)], CANDIDATE)
    records, cache = models.annotate(rows, provider, no_cache(spark), "P ", "m", retries=0, parallel=1)
    assert {(r["figure_id"], r["role"], r["status"]) for r in records.collect()} == {(f, "decor", "ok") for f in ("f1", "f2", "f3")}
    assert sorted(open(log).read().splitlines()) == ["P ", "P c"]
    again, _ = models.annotate(rows, provider, cache, "P ", "m", retries=0)
    assert {r["status"] for r in again.collect()} == {"cached"} and len(open(log).read().splitlines()) == 2


def test_failures_are_tried_again_and_leave_the_figure(spark, tmp_path):
    log = tmp_path / "calls"

    def provider(content, prompt):
        with open(log, "a") as f:
            f.write("x")
        if prompt.endswith("late") and log.stat().st_size % 2 == 0:
            return '{"role": "content"}'
        raise OSError("down")

    one = lambda context: spark.createDataFrame([("f", "i", "a", "a.png", PNG, 9, 9, context)], CANDIDATE)
    late, _ = models.annotate(one("late"), provider, no_cache(spark), "", retries=2, backoff=0, parallel=1)
    assert [(r["role"], r["status"]) for r in late.collect()] == [("content", "ok")] and log.stat().st_size == 2
    never, cache = models.annotate(one("never"), provider, no_cache(spark), "", retries=2, backoff=0, parallel=1)
    assert [(r["role"], r["reason"], r["status"]) for r in never.collect()] == [("ambiguous", "provider_error", "failed")] and cache.count() == 0
    assert log.stat().st_size == 5
    with pytest.raises(ValueError):
        models.ask(one("x"), provider, retries=-1)


def test_classify_leaves_out_and_merges(spark):
    rows = spark.createDataFrame([(f"f{k}", f"i{k}", f"a{k}", "a.png", PNG, 9, 9, "c") for k in range(4)], CANDIDATE)
    uses = spark.createDataFrame([("f0", "i0"), ("f1", "i1"), ("f2", "i2")], "figure_id string, item_id string")
    prior, _ = models.annotate(rows, lambda c, p: '{"role": "decor"}', no_cache(spark), "")
    got, _ = models.classify(rows, lambda c, p: '{"role": "content"}', no_cache(spark), "", uses, spark.createDataFrame([("f1",)], "figure_id string"), spark.createDataFrame([("a2",)], "asset_id string"), prior)
    assert {(r["figure_id"], r["role"]) for r in got.collect()} == {("f0", "content"), ("f1", "decor"), ("f2", "decor"), ("f3", "decor")}


def test_hybrid_without_a_provider_keeps_the_rules(spark):
    figures = spark.createDataFrame([(1, "AB ∥ CD", "", PNG), (2, "nothing", "", None)], "figure_id int, text string, caption string, content binary")
    rels, calls = models.hybrid(figures, None, "")
    assert {r["source"] for r in rels.collect()} == {"rules"} and {r["reason"] for r in calls.collect()} == {"no_provider"}
    rels, calls = models.hybrid(figures, lambda c, p: "not json", "", retries=0)
    assert {(r["figure_id"], r["status"], r["reason"]) for r in calls.collect()} == {(1, "skipped", "rules_sufficient"), (2, "skipped", "asset_unavailable")} and rels.count() == 2


def test_synthetic_blocks_come_first(spark):
    items = spark.createDataFrame([(1, 1, "i1", "definition", "head", "Long text of one. Second line here", ["long", "text"], "c"), (1, 2, "i2", "example", "def", "unmatched", ["yy"], "c")], "doc_id long, item_seq int, item_id string, item_type string, title string, text string, tokens array<string>, chapter string")
    blocks = spark.createDataFrame([(1, "c", 0, 0, "p001-b001", "paragraph", "x", [], False, None), (1, "c", 0, 1, "f9", "figure", "", [], True, "md2"), (1, "c", 0, 2, "f1", "figure", "", [], True, "md1")], "doc_id long, chapter string, page_index int, block_order int, block_id string, type string, text string, tokens array<string>, has_image boolean, attached_to string")
    made = spark.createDataFrame([(1, "md1", "paragraph", "Long text of one.", 3, 1, ["c"]), (1, "md2", "paragraph", "Second line", 7, 1, ["c"]), (1, "md3", "paragraph", "Second line", 9, 1, ["other"])], "doc_id long, block_id string, type string, text string, line int, page_index int, chapter_path array<string>")
    got = [(r["item_id"], r["block_id"]) for r in binding.greedy_binding(items, blocks, synthetic=made).orderBy("item_id", "n").collect()]
    assert got == [("i1", "md1"), ("i1", "f1"), ("i1", "f9"), ("i2", "p001-b001")]


def test_sidecar_without_ids_fails(spark):
    edges = spark.createDataFrame([(1, "attached_to", None, "t"), (1, "caption_for", None, None)], "doc_id int, kind string, source_id string, target_id string")
    with pytest.raises(Exception, match="without block ids"):
        structure.attachments_by_target(edges).collect()
    assert structure.attachments_by_target(edges.filter("kind <> 'attached_to'")).collect() == []


def test_align_empty_and_null(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    layout = spark.createDataFrame([], "doc_id int, layout_chars int, layout_text_blocks int")
    visuals = spark.createDataFrame([], "doc_id int, ord int, block_id string, page_index int, page_number int, path string, asset_id string")
    got = structure.align(docs, layout, visuals)
    assert {(r["doc_id"], r["status"], r["coverage"]) for r in got["summary"].collect()} == {(1, "missing_markdown", 0.0), (2, "not_needed", 1.0)}
    assert got["blocks"].count() == 0 and got["relations"].count() == 0


def test_plans_on_disk(spark, tmp_path):
    plans = spark.createDataFrame([(1, "t")], "plan_seq int, topic_id string")
    pruning = spark.createDataFrame([("t", True), ("u", False)], "topic_id string, pruned boolean")
    made = {"plans": plans, "pruning": pruning, "superseded": plans.limit(0)}
    for _ in range(2):
        reports.write_plans(made, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/plans").count() == 1 and spark.read.json(f"{tmp_path}/topic_pruning").count() == 1
    assert {p.name for p in tmp_path.iterdir()} == {"plans", "topic_pruning"}
    with pytest.raises(Exception, match="planned"):
        replace(plans.withColumn("x", F.raise_error(F.lit("planned"))), f"{tmp_path}/plans")
    assert spark.read.json(f"{tmp_path}/plans").count() == 1


def served(*answers):
    calls, pauses, left = [], [], list(answers)

    def transport(method, url, headers, body):
        calls.append((method, url, headers))
        status, head, data = left.pop(0)
        if status == 0:
            raise OSError("lost")
        return status, head, json.dumps(data).encode()

    return cloud.Service("secret", "http://host/", transport, sleep=pauses.append), calls, pauses


def test_service_tries_again_and_waits(tmp_path):
    ok = (200, {}, {"data": {"state": "done"}})
    service, calls, pauses = served((0, {}, None), (429, {"Retry-After": "99"}, None), (503, {}, None), ok)
    assert service.batch("b") == {"state": "done"} and pauses == [1.0, 60.0, 4.0] and len(calls) == 4
    service, calls, pauses = served((403, {}, None))
    with pytest.raises(cloud.AuthError):
        service.batch("b")
    service, calls, pauses = served(*[(500, {}, None)] * 5)
    with pytest.raises(cloud.ServiceError, match="5 attempts"):
        service.batch("b")
    service, calls, pauses = served((404, {}, None))
    with pytest.raises(cloud.ServiceError, match="404"):
        service.batch("b")
    service, calls, pauses = served((200, {}, {"data": {"state": "running"}}), ok)
    assert service.wait("b", lambda s: s["state"] == "done") == {"state": "done"} and pauses == [5.0]


def test_upload_hides_the_token(tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    service, calls, _ = served((200, {}, {"data": {"batch_id": "b", "file_urls": ["http://put/1"]}}), (200, {}, None))
    grant = service.request_upload([{"name": "a.pdf", "data_id": "d", "size": 4}])
    service.upload(grant["file_urls"][0], str(tmp_path / "a.pdf"))
    assert "Authorization" in calls[0][2] and "Authorization" not in calls[1][2]
    with pytest.raises(cloud.ServiceError):
        service.request_upload([])
    with pytest.raises(cloud.AuthError):
        cloud.Service("", "http://host")


def test_hybrid_reads_the_rules_from_the_texts_once(spark):
    figures = spark.createDataFrame([(1, "AB 平行", ""), (2, "nothing here", "")], "figure_id long, text string, caption string").withColumn("content", F.lit(b"x"))
    answer = '{"relations": [{"type": "parallel", "entities": ["cd"], "confidence": 0.6}], "observations": []}'
    rels, _ = models.hybrid(figures, lambda c, p: answer, "", retries=0)
    assert sorted((r["figure_id"], r["key"]) for r in rels.collect()) == [(1, "parallel::ab"), (2, "parallel::cd")]
    assert "RLIKE" not in rels._jdf.queryExecution().optimizedPlan().toString()
