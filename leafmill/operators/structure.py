"""Document structure: heading parents, captions, figure attachment, continuations, Markdown to layout alignment.

Blocks have doc_id, page_index, block_order, block_id, type, level, bbox, text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import boxes
from leafmill.functions import text as T
from leafmill.operators import segment
from leafmill.tables import materialize

# Block types.
TEXT_TYPES = ("paragraph", "text", "list", "list_item", "other")
VISUAL_TYPES = ("figure", "image", "table", "chart")
CAPTION_TYPES = ("caption", "image_caption", "table_caption")
EDGE = ["doc_id", "kind", "source_id", "target_id", "confidence", "evidence", "review_state"]


def _edges(df: DataFrame, kind: str, source: str, target: str, confidence: Column, evidence: str, state: Column) -> DataFrame:
    return df.select("doc_id", F.lit(kind).alias("kind"), F.col(source).alias("source_id"), F.col(target).alias("target_id"), confidence.alias("confidence"), F.lit(evidence).alias("evidence"), state.alias("review_state"))


def is_caption(kind: Column, text: Column) -> Column:
    return kind.isin(*CAPTION_TYPES) | F.coalesce(text, F.lit("")).rlike(r"(?iU)^(图|表|figure|table)\s*\d")


def heading_parents(blocks: DataFrame, levels: Sequence[int] | None = None) -> DataFrame:
    """block_id, parent_id, inferred: the latest earlier heading of a lower level; for other blocks the latest heading.

    The parent of a heading of level L is the last heading before it with a level under L, which is what a stack of
    open headings gives; so one running `last` for each level that occurs and a greatest position do it. `levels`, where
    known to hold all that occur, save a pass over the blocks.
    """
    w0 = W.partitionBy("doc_id").orderBy("page_index", "block_order")
    before = w0.rowsBetween(W.unboundedPreceding, -1)
    head = F.col("type") == "heading"
    if levels is None:
        levels = [r["level"] for r in blocks.filter(head & F.col("level").isNotNull()).select("level").distinct().collect()]  # a row for each level in use
    levels = sorted({*levels, 1, 2})
    rows = blocks.withColumn("pos", F.row_number().over(w0)).withColumn("earlier", F.coalesce(F.max(head.cast("int")).over(before), F.lit(0)))
    guess = F.when(F.col("text").rlike("^第.+章|(?i)^chapter"), 1).when(F.col("text").rlike("^第.+节|^\\d+\\.\\d+"), 2).when(F.col("earlier") == 0, 1).otherwise(2)
    rows = rows.withColumns({"inferred": head & F.col("level").isNull(), "lvl": F.when(head, F.coalesce("level", guess))})
    lasts = {f"h{i}": F.last(F.when(F.col("lvl") == k, F.struct("pos", "block_id", "inferred")), ignorenulls=True).over(before) for i, k in enumerate(levels)}
    rows = rows.withColumns(lasts)
    allowed = [F.when(~head | (F.lit(k) < F.col("lvl")), F.col(f"h{i}")) for i, k in enumerate(levels)]
    rows = rows.withColumn("parent", F.array_max(F.array_compact(F.array(*allowed)))).filter(F.col("parent").isNotNull())
    inferred = F.when(head, F.col("inferred")).otherwise(F.col("parent.inferred"))
    return rows.select("doc_id", "block_id", F.col("parent.block_id").alias("parent_id"), inferred.alias("inferred"))


def nearest_unique(left: DataFrame, right: DataFrame, on: list[str], distance: Column, left_id: str, right_id: str, gap: float = 0.001) -> DataFrame:
    """left_id, right_id of the nearest right row of each left row, where no other is within `gap` of it."""
    met = left.join(right, on).withColumn("_d", distance)
    w = W.partitionBy(*on, left_id).orderBy("_d", right_id)
    met = met.withColumns({"_i": F.row_number().over(w), "_next": F.lead("_d").over(w)})
    return met.filter((F.col("_i") == 1) & (F.col("_next").isNull() | (F.col("_next") - F.col("_d") >= gap)))


def captions(blocks: DataFrame) -> DataFrame:
    """Caption -> nearest visual of its page; ties give none."""
    c = blocks.filter(is_caption(F.col("type"), F.col("text"))).select("doc_id", "page_index", F.col("block_id").alias("caption_id"), F.col("bbox").alias("c_box"))
    v = blocks.filter(F.col("type").isin(*VISUAL_TYPES)).select("doc_id", "page_index", F.col("block_id").alias("visual_id"), F.col("bbox").alias("v_box"))
    met = nearest_unique(c, v, ["doc_id", "page_index"], boxes.distance(F.col("c_box"), F.col("v_box")), "caption_id", "visual_id")
    return _edges(met, "caption_for", "caption_id", "visual_id", F.lit(0.95), "nearest_visual", F.lit("confirmed"))


def attachments(blocks: DataFrame, caption_edges: DataFrame) -> DataFrame:
    """Visual -> nearest text before it on its page."""
    v = blocks.filter(F.col("type").isin(*VISUAL_TYPES)).select("doc_id", "page_index", F.col("block_id").alias("visual_id"), F.col("bbox").alias("v_box"), F.col("block_order").alias("v_order"))
    t = blocks.filter(F.col("type").isin(*TEXT_TYPES) & ~is_caption(F.col("type"), F.col("text"))).select("doc_id", "page_index", F.col("block_id").alias("text_id"), F.col("bbox").alias("t_box"), F.col("block_order").alias("t_order"))
    far = boxes.distance(F.col("v_box"), F.col("t_box")) + F.when(F.col("t_order") < F.col("v_order"), 0.0).otherwise(1e6)
    met = nearest_unique(v, t, ["doc_id", "page_index"], far, "visual_id", "text_id").filter(F.col("t_order") < F.col("v_order"))
    captioned = caption_edges.select("doc_id", F.col("target_id").alias("visual_id"), F.lit(True).alias("captioned")).distinct()
    met = met.join(captioned, ["doc_id", "visual_id"], "left")
    return _edges(met, "attached_to", "visual_id", "text_id", F.when(F.col("captioned"), 0.80).otherwise(0.65), "nearest_preceding_text", F.lit("suggested"))


def flows_on(text: Column) -> Column:
    """Ten characters or more that do not end a sentence."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(t) >= 10) & ~t.rlike("[。！？!?.;；:：]$")


def listed(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"^\s*([-*+•]|[0-9]+[.)、])")


def continuations(blocks: DataFrame) -> DataFrame:
    """Last text of a page -> first text of the next page, where the first does not end its sentence."""
    t = blocks.filter(F.col("type").isin(*TEXT_TYPES))
    row = F.struct("block_id", "text", "bbox")
    last = t.groupBy("doc_id", "page_index").agg(F.max_by(row, "block_order").alias("a"))
    first = t.groupBy("doc_id", "page_index").agg(F.min_by(row, "block_order").alias("b")).withColumn("page_index", F.col("page_index") - 1)
    met = last.join(first, ["doc_id", "page_index"]).filter(flows_on(F.col("a.text")) & ~listed(F.col("b.text")))
    wide = boxes.horizontal_overlap(F.col("a.bbox"), F.col("b.bbox")) >= 0.35
    return _edges(met, "continues_to", "a.block_id", "b.block_id", F.when(wide, 0.90).otherwise(0.60), "page_turn", F.when(wide, "confirmed").otherwise("suggested"))


def recover(blocks: DataFrame) -> DataFrame:
    """All edges of the layout."""
    parents = heading_parents(blocks)
    sure = ~F.col("inferred")
    up = _edges(parents, "parent_heading", "block_id", "parent_id", F.when(sure, 0.95).otherwise(0.75), "heading_level", F.when(sure, "confirmed").otherwise("suggested"))
    said = captions(blocks)
    return up.unionByName(said).unionByName(attachments(blocks, said)).unionByName(continuations(blocks))


def paired_images(markdown: DataFrame, layout: DataFrame) -> DataFrame:
    """k-th use of a path in the Markdown with the k-th visual of that path: markdown has doc_id, path, line_no;
    layout has doc_id, path, block_id, page_index, block_order."""
    m = markdown.withColumn("k", F.row_number().over(W.partitionBy("doc_id", "path").orderBy("line_no")))
    v = layout.withColumn("k", F.row_number().over(W.partitionBy("doc_id", "path").orderBy("page_index", "block_order")))
    return m.join(v, ["doc_id", "path", "k"])


def paired_images_or_stems(markdown: DataFrame, layout: DataFrame) -> DataFrame:
    """doc_id, line_no, block_id: Markdown images in turn with the first unused visual of their path, else of their stem.

    markdown: doc_id, target, line_no and, where a line holds several, k. layout: doc_id, path, asset_id, block_id, page_index, block_order. Both passes share
    what is used, so a document is one row with its own images; a worker takes many such rows at a time.
    """
    import pyarrow as pa

    def matched(images: list[dict], visuals: list[dict]) -> Iterator[tuple[int, str]]:
        waiting: dict[tuple[str, str], list[str]] = {}
        for v in reversed(visuals):
            for name in (("path", v["p"]), ("stem", v["s"] or v["asset_id"])):
                if name[1]:
                    waiting.setdefault(name, []).append(v["block_id"])
        used = set()
        for m in images:
            for name in (("path", m["p"]), ("stem", m["s"])):
                queue = waiting.get(name, [])
                while queue and queue[-1] in used:
                    queue.pop()
                if queue:
                    used.add(queue[-1])
                    yield m["line_no"], queue.pop()
                    break

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            docs, images, visuals = (part.column(n).to_pylist() for n in ("doc_id", "images", "visuals"))
            rows = [(d, *m) for d, i, v in zip(docs, images, visuals, strict=True) for m in matched(i, v)]
            kinds = part.schema.field("doc_id").type, pa.int32(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["doc_id", "line_no", "block_id"])

    kind = markdown.schema["doc_id"].dataType.simpleString()
    place = F.col("k") if "k" in markdown.columns else F.lit(0).alias("k")
    name = lambda target: (T.image_identity(F.col(target))["path"].alias("p"), T.image_identity(F.col(target))["stem"].alias("s"))
    folded = lambda df, out, *cols: df.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(out))
    left = folded(markdown.select("doc_id", "line_no", place, *name("target")), "images", "line_no", "k", "p", "s")
    right = layout.withColumn("path", F.coalesce("path", F.lit(""))).select("doc_id", "page_index", "block_order", *name("path"), "asset_id", "block_id")
    right = folded(right, "visuals", "page_index", "block_order", "p", "s", "asset_id", "block_id")
    return left.join(right, "doc_id").mapInArrow(pair, f"doc_id {kind}, line_no int, block_id string")


def image_anchors(images: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, line_no, target_id: for each image line the last block of text that begins under the heading in force, else that heading.

    images: doc_id, line_no. blocks: doc_id, block_id, type, first_line, last_line. Running maxima, no pairs.
    """
    head = F.col("type") == "heading"
    rows = blocks.select("doc_id", F.col("first_line").alias("at"), F.when(head, F.struct("first_line", "block_id")).alias("h"), F.when(~head, F.struct("last_line", "block_id", "first_line")).alias("t"), F.lit(None).cast("int").alias("line_no"))
    marks = images.select("doc_id", F.col("line_no").alias("at"), F.lit(None).cast(rows.schema["h"].dataType).alias("h"), F.lit(None).cast(rows.schema["t"].dataType).alias("t"), F.col("line_no").cast("int").alias("line_no")).distinct()
    w = W.partitionBy("doc_id").orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    both = rows.unionByName(marks).withColumns({"heading": F.max("h").over(w), "near": F.max("t").over(w)}).filter(F.col("line_no").isNotNull())
    target = F.when(F.col("near.first_line") > F.coalesce("heading.first_line", F.lit(0)), F.col("near.block_id")).otherwise(F.col("heading.block_id"))
    return both.select("doc_id", "line_no", target.alias("target_id")).filter(F.col("target_id").isNotNull())


def heading_of_images(lines: DataFrame) -> DataFrame:
    """doc_id, path, heading: the heading in force at the first marker of each path (the first marker of a line counts). lines: doc_id, line_no, line."""
    rows = lines.withColumn("line", T.strip(F.col("line")))
    head = F.col("line").startswith("#")
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("heading", F.coalesce(F.last(F.when(head, T.strip(F.regexp_replace("line", "^#+", ""))), ignorenulls=True).over(w), F.lit("")))
    path = T.strip(F.regexp_extract("line", r"!\[image\]\(([^)]*)\)", 1))
    marks = rows.filter(~head).select("doc_id", "line_no", path.alias("path"), "heading").filter("path <> ''")
    return marks.groupBy("doc_id", "path").agg(F.min_by("heading", "line_no").alias("heading"))


def nearest_anchor(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """block line -> nearest anchor line; ties: the following one, then the lower line, then the id. Two running windows, no pairs."""
    marks = anchors.groupBy("doc_id", F.col("anchor_line").alias("line_no")).agg(F.min("anchor_id").alias("anchor_id"))
    rows = blocks.select("doc_id", "line_no", F.lit(None).cast(marks.schema["anchor_id"].dataType).alias("anchor_id"), F.lit(True).alias("asks")).unionByName(marks.withColumn("asks", F.lit(False)))
    mark = F.when(~F.col("asks"), F.struct("line_no", "anchor_id"))
    w = W.partitionBy("doc_id").orderBy("line_no")
    seen = rows.withColumns({"p": F.max(mark).over(w.rangeBetween(W.unboundedPreceding, -1)), "n": F.min(mark).over(w.rangeBetween(W.currentRow, W.unboundedFollowing))}).filter("asks")
    way = lambda c, behind: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.line_no") - F.col("line_no")).alias("dist"), F.lit(behind).alias("behind"), F.col(f"{c}.anchor_id").alias("anchor_id")))
    best = seen.withColumn("a", F.least(way("p", 1), way("n", 0))).filter(F.col("a").isNotNull())
    return best.select("doc_id", "line_no", "a.anchor_id", F.col("a.dist").alias("dist"), F.when(F.col("a.dist") <= 2, 0.90).otherwise(0.65).alias("confidence"))


def alignment_status(facts: DataFrame) -> DataFrame:
    """facts (markdown_chars, layout_chars, layout_blocks, layout_text_blocks, matched) with coverage, share and status."""
    coverage = F.when(F.col("markdown_chars") > 0, F.least(F.lit(1.0), F.col("layout_chars") / F.col("markdown_chars"))).otherwise(1.0)
    share = F.when(F.col("layout_blocks") > 0, F.col("layout_text_blocks") / F.col("layout_blocks")).otherwise(0.0)
    status = F.when(F.col("markdown_chars").isNull(), "missing_markdown").when((F.col("markdown_chars") < 200) | (coverage >= 0.20) | (share >= 0.10), "not_needed").when(F.col("matched") == 0, "unavailable_no_image_matches").otherwise("active")
    return facts.withColumns({"coverage": coverage, "share": share, "status": status})


# Why a text is aligned, or is not.
ALIGNMENT_REASONS = {
    "missing_markdown": "normalized Markdown is unavailable",
    "short": "Markdown text is below the fallback minimum",
    "covered": "layout text coverage is sufficient",
    "structured": "layout contains enough structured text blocks",
    "unavailable_no_image_matches": "fallback required but no Markdown image matched layout",
    "active": "layout text coverage and text-block share require fallback",
}


def locate_blocks(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """blocks (doc_id, block_id, first_line, last_line) with anchor_block_id, page_index, page_number, location_confidence of the anchor
    whose line is nearest to the block's lines; ties: one that is not before the last line, then the lower line, then the id.

    anchors: doc_id, line_no, block_id, page_index, page_number. The nearest is one of three: the last before the block, the first from
    its first line on and the first from its last line on; running windows find them, with no pairs.
    """
    marks = anchors.groupBy("doc_id", F.col("line_no").alias("at")).agg(F.min(F.struct("block_id", "page_index", "page_number")).alias("a"))
    mark = F.struct(F.col("at").alias("line"), F.col("a"))
    none = F.lit(None)
    asks = blocks.select("doc_id", "block_id", "first_line", "last_line", F.explode(F.array("first_line", "last_line")).alias("at")).distinct()
    rows = asks.withColumn("m", none.cast(marks.select(mark.alias("m")).schema["m"].dataType))
    told = marks.select("doc_id", none.cast("string").alias("block_id"), none.cast("int").alias("first_line"), none.cast("int").alias("last_line"), "at", mark.alias("m"))
    w = W.partitionBy("doc_id").orderBy("at")
    seen = rows.unionByName(told).withColumns({"p": F.max("m").over(w.rangeBetween(W.unboundedPreceding, -1)), "n": F.min("m").over(w.rangeBetween(W.currentRow, W.unboundedFollowing))}).filter(F.col("block_id").isNotNull())
    far = lambda line: F.greatest(F.lit(0), line - F.col("last_line"), F.col("first_line") - line)
    way = lambda c: F.when(F.col(c).isNotNull(), F.struct(far(F.col(c)["line"]).alias("dist"), (F.col(c)["line"] < F.col("last_line")).cast("int").alias("behind"), F.col(c)["line"].alias("line"), F.col(c)["a"].alias("a")))
    best = seen.groupBy("doc_id", "block_id").agg(F.min(F.least(way("p"), way("n"))).alias("b")).filter(F.col("b").isNotNull())
    found = best.select("doc_id", "block_id", F.col("b.a.block_id").alias("anchor_block_id"), "b.a.page_index", "b.a.page_number", F.when(F.col("b.dist") <= 2, 0.90).otherwise(0.65).alias("location_confidence"))
    return blocks.join(found, ["doc_id", "block_id"])


def align(docs: DataFrame, layout: DataFrame, visuals: DataFrame) -> dict[str, DataFrame]:
    """Markdown text put beside a layout that has too little text of its own: summary, blocks, relations.

    docs: doc_id (unique), text (null: no Markdown). layout: doc_id, layout_chars, layout_text_blocks. visuals: doc_id, ord, block_id,
    page_index, page_number, path, asset_id. summary has a row a document; blocks and relations those of active ones. Documents that do
    not call for it are left out before images are matched. Images, numbers of documents and the blocks of active ones are
    written once each, whatever reads them.
    """
    blocks, images = segment.markdown_blocks(docs)
    images = materialize(images)
    each = docs.select("doc_id", T.text_chars(F.col("text")).alias("markdown_chars")).join(layout, "doc_id", "left")
    each = each.join(images.groupBy("doc_id").agg(F.count(F.lit(1)).alias("markdown_images")), "doc_id", "left")
    each = each.join(visuals.groupBy("doc_id").agg(F.count(F.lit(1)).alias("layout_images")), "doc_id", "left")
    each = materialize(each.fillna(0, ["layout_chars", "layout_text_blocks", "markdown_images", "layout_images"]).withColumn("layout_blocks", F.col("layout_text_blocks") + F.col("layout_images")))
    asks = alignment_status(each.withColumn("matched", F.lit(1))).filter("status = 'active'").select("doc_id")
    placed = visuals.select("doc_id", "block_id", "page_index", "page_number", "path", "asset_id", F.col("ord").alias("block_order")).join(asks, "doc_id", "left_semi")
    met = paired_images_or_stems(images.join(asks, "doc_id", "left_semi"), placed.withColumn("page_index", F.lit(0)))
    met = materialize(met.join(placed.select("doc_id", "block_id", "page_index", "page_number"), ["doc_id", "block_id"]))
    counted = each.join(met.groupBy("doc_id").agg(F.count(F.lit(1)).alias("matched")), "doc_id", "left").fillna(0, ["matched"])
    summary = alignment_status(counted)
    live, open_ = F.col("status") == "active", F.col("status").isin("active", "unavailable_no_image_matches")
    reason = F.when(F.col("status") != "not_needed", F.col("status")).when(F.col("markdown_chars") < 200, "short").when(F.col("coverage") >= 0.20, "covered").otherwise("structured")
    told = F.create_map(*[F.lit(x) for pair in ALIGNMENT_REASONS.items() for x in pair])
    parts = met.select("doc_id").distinct()
    used = materialize(blocks.join(parts, "doc_id", "left_semi"))
    summary = summary.join(used.groupBy("doc_id").agg(F.count(F.lit(1)).alias("synthetic_blocks")), "doc_id", "left").fillna(0, ["synthetic_blocks"])
    summary = summary.withColumns({"reason": told[reason], "coverage": F.when(F.col("status") == "missing_markdown", 0.0).otherwise(F.col("coverage")), "markdown_chars": F.coalesce("markdown_chars", F.lit(0)), "markdown_only": F.when(open_, F.col("markdown_images") - F.col("matched")).otherwise(0), "layout_only": F.when(open_, F.col("layout_images") - F.col("matched")).otherwise(0), "synthetic_blocks": F.when(live, F.col("synthetic_blocks")).otherwise(0)})
    warn = lambda name, n: F.when(F.col(n) > 0, F.concat(F.lit(f"unmatched_{name}_images:"), F.col(n).cast("string")))
    summary = summary.withColumn("warnings", F.array_compact(F.array(warn("markdown", "markdown_only"), warn("layout", "layout_only"))))
    tree = used.select("doc_id", F.lit(0).alias("page_index"), F.col("first_line").alias("block_order"), "block_id", F.col("block_type").alias("type"), F.col("heading_level").alias("level"), "text")
    up = _edges(heading_parents(tree, range(1, 7)).filter(F.col("parent_id").isNotNull()), "parent_heading", "block_id", "parent_id", F.lit(1.0), "markdown_heading_level", F.lit("confirmed"))
    marks = met.select("doc_id", "line_no", F.col("block_id").alias("visual_id"))
    to = image_anchors(marks.select("doc_id", "line_no"), used.select("doc_id", "block_id", F.col("block_type").alias("type"), "first_line", "last_line")).join(marks, ["doc_id", "line_no"])
    tied = _edges(to, "attached_to", "visual_id", "target_id", F.lit(0.85), "markdown_image_anchor", F.lit("suggested"))
    return {"summary": summary, "blocks": locate_blocks(used, met), "relations": up.unionByName(tied)}


def checked_sidecar(edges: DataFrame) -> DataFrame:
    """edges (doc_id, kind, source_id, target_id), which fail the query where an attachment lacks an id."""
    bad = (F.col("kind") == "attached_to") & (F.col("source_id").isNull() | F.col("target_id").isNull())
    return edges.withColumn("kind", F.when(bad, F.raise_error(F.concat(F.lit("attached_to relation without block ids in document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))).otherwise(F.col("kind")))


def attachments_by_target(edges: DataFrame) -> DataFrame:
    """doc_id, target_id, sources: the distinct blocks attached to each block, sorted."""
    rows = checked_sidecar(edges).filter("kind = 'attached_to'")
    return rows.groupBy("doc_id", "target_id").agg(F.array_sort(F.collect_set("source_id")).alias("sources"))
