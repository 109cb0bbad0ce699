"""Render model, PDF bytes and manifests of export plans."""

from __future__ import annotations

import textwrap

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T


def render_model(items: DataFrame, figures: DataFrame, roles: DataFrame, blocked: DataFrame) -> DataFrame:
    """plan_id, pos, line_seq, style, content: one row for each emitted line.

    items: plan_id, pos, item_id, title, text. figures: item_id, figure_id, present. Decor is not drawn; a figure whose
    file is absent or that is blocked is reported by a line of its own.
    """
    body = T.without_image_markers(F.coalesce("text", F.lit("")))
    lines = F.filter(F.split(body, "\n"), lambda x: F.trim(x) != "")
    head = items.select("plan_id", "pos", F.lit(0).alias("line_seq"), F.lit("heading").alias("style"), F.coalesce("title", F.lit("")).alias("content"))
    text = items.select("plan_id", "pos", F.posexplode(lines).alias("k", "content")).select("plan_id", "pos", (F.col("k") + 1).alias("line_seq"), F.lit("body").alias("style"), "content")
    drawn = items.select("plan_id", "pos", "item_id").join(figures, "item_id").join(roles, ["figure_id", "item_id"], "left").join(blocked.withColumn("blocked", F.lit(True)), "figure_id", "left")
    style = F.when(F.col("role") == "decor", "dropped").when(F.col("blocked"), "blocked").when(~F.col("present"), "missing").otherwise("figure")
    pics = drawn.select("plan_id", "pos", (F.dense_rank().over(_by_item()) + 100_000).alias("line_seq"), style.alias("style"), F.col("figure_id").alias("content"))
    return head.unionByName(text).unionByName(pics)


def _by_item():
    from pyspark.sql.window import Window as W

    return W.partitionBy("plan_id", "pos").orderBy("figure_id")


def validation(lines: DataFrame) -> DataFrame:
    """plan_id, items, rendered, missing, blocked, dropped, status."""
    n = lambda s: F.count_distinct(F.when(F.col("style") == s, F.col("content")))
    out = lines.groupBy("plan_id").agg(F.count_distinct("pos").alias("items"), n("figure").alias("rendered"), n("missing").alias("missing"), n("blocked").alias("blocked"), n("dropped").alias("dropped"))
    status = F.when(F.col("blocked") > 0, "blocked").when(F.col("missing") == 0, "ready").when(F.col("rendered") == 0, "blocked").otherwise("warning")
    return out.withColumn("status", status)


def latin_only(x: Column) -> Column:
    """Characters that the standard PDF fonts lack become a question mark, a run at a time."""
    return F.regexp_replace(x, "[^\\u0000-\\u007F\\u00A0-\\u024F]+", "?")


def pdf_bytes(lines: list[tuple[str, str]], title: str, per_page: int = 48) -> bytes:
    """A plain PDF 1.4 of (style, text) lines in the standard fonts; lines too wide for the page are broken at spaces."""
    lines = [(style, part) for style, text in lines for part in textwrap.wrap(text, 66 if style == "heading" else 95, drop_whitespace=True) or [""]]
    pages = [lines[i : i + per_page] for i in range(0, len(lines), per_page)] or [[]]
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(pages), b" ".join(b"%d 0 R" % (5 + 2 * k) for k in range(len(pages)))), b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>", b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica-Bold /Encoding /WinAnsiEncoding >>"]
    show = lambda s: s.encode("cp1252", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)")
    for k, page in enumerate(pages):
        body = b"BT /F1 8 Tf 50 810 Td (%s) Tj ET\n" % show(title) + b"BT /F1 8 Tf 280 20 Td (%d / %d) Tj ET\nBT 15 TL 50 790 Td\n" % (k + 1, len(pages))
        for style, text in page:
            body += (b"/F2 13 Tf " if style == "heading" else b"/F1 10 Tf ") + b"(%s) Tj T*\n" % show(text)
        body += b"ET"
        objects.append(b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 595 842] /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> /Contents %d 0 R >>" % (6 + 2 * k))
        objects.append(b"<< /Length %d >>\nstream\n%s\nendstream" % (len(body), body))
    out, at = b"%PDF-1.4\n", []
    for k, o in enumerate(objects):
        at.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (k + 1, o)
    table = b"".join(b"%010d 00000 n \n" % a for a in at)
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer << /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(at) + 1, table, len(at) + 1, len(out))


def render_pdf(lines: DataFrame) -> DataFrame:
    """plan_id, pdf, sha256: a plan is one file, so its lines are one task."""

    def draw(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["pos", "line_seq"])
        plan = part["plan_id"].iloc[0]
        shown = part[part["style"].isin(["heading", "body", "figure"])]
        return pd.DataFrame({"plan_id": [plan], "pdf": [pdf_bytes(list(zip(shown["style"], shown["content"], strict=True)), str(plan))]})

    kind = lines.schema["plan_id"].dataType.simpleString()
    ready = lines.withColumn("content", latin_only(F.col("content")))
    return ready.groupBy("plan_id").applyInPandas(draw, f"plan_id {kind}, pdf binary").withColumn("sha256", F.sha2("pdf", 256))


def stale(listing: DataFrame, planned: DataFrame, name: str = "filename") -> DataFrame:
    """Files of an earlier run that no plan names."""
    return listing.join(planned, name, "left_anti")
