import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from leafmill.operators import media
from leafmill.plans import stages
from leafmill.sources import fetch, layout
from leafmill.streaming import intake


def png(w, h, f):
    raw = b"".join(b"\0" + bytes(f(x, y) for x in range(w)) for y in range(h))
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_layout_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"pages": [{"page_index": 0, "page_number": 0, "blocks": [{"block_id": "x", "type": "heading", "level": 1, "text": "T"}, {"text": "p"}]}]}))
    (tmp_path / "b.json").write_text(json.dumps({"pdf_info": [{"page_idx": 2, "para_blocks": [{"type": "title", "text": "H"}, {"type": "text", "blocks": []}, {"type": "image", "blocks": [{"lines": [{"spans": [{"type": "image", "image_path": "i.png", "bbox": [1, 2, 3, 4]}]}]}]}]}]}))
    got = {r["block_id"]: r for r in layout.read_layout(spark, str(tmp_path)).collect()}
    assert set(got) == {"x", "p000-b001", "p002-b000", "p002-b002"}
    assert got["x"]["page_number"] == 1 and got["p002-b002"]["type"] == "figure" and got["p002-b002"]["image_url"] == "i.png" and got["p002-b000"]["type"] == "heading"


def test_layout_without_either_shape_fails(spark, tmp_path):
    (tmp_path / "c.json").write_text("{}")
    with pytest.raises(Exception, match="neither"):
        layout.read_layout(spark, str(tmp_path)).collect()


def test_inbox(spark, tmp_path):
    for name in ("t1/meta.json", "t1/full.md", "t2/full.md", "_archive/x.md"):
        p = tmp_path / "inbox" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("{}")
    files = layout.scan_inbox(spark, str(tmp_path / "inbox"))
    assert {r["task_id"] for r in files.collect()} == {"t1", "t2"}
    assert [tuple(r) for r in layout.inbox_problems(files).collect()] == [("t2", "missing meta.json")]


def test_images_and_difference_hash(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(34, 32, lambda x, y: 255 - 7 * x))
    (tmp_path / "b.png").write_bytes(png(34, 32, lambda x, y: 7 * x))
    (tmp_path / "c.png").write_bytes(b"broken")
    got = {r["path"].rsplit("/", 1)[1]: r for r in layout.read_images(spark, str(tmp_path)).collect()}
    assert (got["a.png"]["width"], got["a.png"]["height"], got["a.png"]["magic"]) == (34, 32, "png") and got["c.png"]["width"] == -1
    images = spark.read.format("image").load(str(tmp_path)).withColumn("path", F.element_at(F.split("image.origin", "/"), -1))
    bits = {r["path"]: r["bits"] for r in media.difference_hash(images, "path").collect()}
    assert bits["a.png"] == [-1] * 4 and bits["b.png"] == [0] * 4 and "c.png" not in bits


def test_download_from_mirror(spark, tmp_path):
    (tmp_path / "x.png").write_bytes(b"1")
    urls = spark.createDataFrame([("http://h/x.png?a",), ("http://h/y.png",), ("http://h/x.png?a",)], "url string")
    got = {r["url"]: r["status"] for r in fetch.download(urls, fetch.first_of(fetch.mirror(str(tmp_path)))).collect()}
    assert got == {"http://h/x.png?a": "ok", "http://h/y.png": "failed"}


def test_stage_records(spark):
    rec = spark.createDataFrame([(1, "a", 1, "t1", "running", None, "f1", None), (1, "a", 2, "t2", "completed", None, None, "o")], "doc_id long, stage string, ord int, at string, status string, error string, input_fingerprint string, output_fingerprint string")
    state = stages.fold_records(rec).first()
    assert (state["status"], state["input_fingerprint"], state["first_started_at"]) == ("completed", "f1", "t1")
    want = spark.createDataFrame([(1, "a", "f2"), (1, "b", "f1")], "doc_id long, stage string, input_fingerprint string")
    assert [r["stage"] for r in stages.to_run(rec, want).collect()] == ["b"]
    assert sorted(r["stage"] for r in stages.to_run(rec, want, True).collect()) == ["a", "b"]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# x")
    q = intake.inbox_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("inbox_rows").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("inbox_rows").first()["text"] == "# x"
    (tmp_path / "dec").mkdir()
    schema = "k int, v string, ord int"
    for n, rows in enumerate(([(1, "a", 1), (1, "b", 2)], [(1, "c", 3), (2, "d", 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "dec"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "dec"))
        intake.decisions_upsert(stream, str(tmp_path / "table"), ["k"], "ord", str(tmp_path / "cp")).awaitTermination(60)
    got = {(r["k"], r["v"]) for r in spark.read.schema(schema).parquet(str(tmp_path / "table" / "v=2")).collect()}
    assert got == {(1, "c"), (2, "d")}
