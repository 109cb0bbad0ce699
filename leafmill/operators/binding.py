"""Bind items to layout blocks: a greedy forward match in each document, then the nested book."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators.segment import carry_forward

# Block types that an item type expects, and types that always fit.
EXPECTED = {
    "chapter": {"heading"}, "section": {"heading"}, "definition": {"definition"}, "theorem": {"theorem"},
    "example": {"worked_example", "example"}, "worked_example": {"worked_example"}, "exercise": {"exercise"},
    "solution": {"solution"}, "summary": {"chapter_summary", "summary"},
}
ALWAYS = {"heading", "paragraph", "other"}
BOUND = "doc_id long, item_id string, block_id string, n int, page_index int"


def greedy_binding(items: DataFrame, blocks: DataFrame, max_blocks: int = 6, synthetic: DataFrame | None = None) -> DataFrame:
    """doc_id, item_id, block_id, n, page_index.

    items: doc_id, item_seq, item_id, item_type, title, tokens, chapter and, where given, text (its first sentence is the head that a
    block may hold, else the title). blocks: doc_id, chapter, page_index, block_order, block_id, type, text, tokens, has_image,
    attached_to (a block id or null). The cursor over the blocks moves forward only on success; a used block is not used again;
    figures attached to a block go to the item that holds it.

    synthetic: those of `synthetic_blocks`. An item that holds some, or lies in one, takes the best of them and uses up all; figures
    attached to any of them follow without a limit, and the cursor stays. The match of an item depends on all before it, so a
    document is one sequential task (of its own items and blocks).
    """

    def bind(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows, used, cursor = [], set(), 0
        left = left.sort_values("item_seq")
        free = right[right["made"]].sort_values(["block_order", "block_id"]).to_dict("records")
        order = right[~right["made"]].sort_values(["chapter", "page_index", "block_order"], na_position="first").to_dict("records")
        attached = {}
        for b in order:
            if b["attached_to"] and b["type"] == "figure":
                attached.setdefault(b["attached_to"], []).append(b)
        for it in left.to_dict("records"):
            words, head = _set(it["tokens"]), (it["head"] or "")[:10]
            fits = lambda b: not b["chapter"] or b["chapter"] == (it["chapter"] or "")  # noqa: B023, E731
            own = _contained(it, free, fits)
            if own:
                taken = {b["block_id"] for b in own}
                free = [b for b in free if b["block_id"] not in taken]
                held, targets, room = [own[0]], sorted(own, key=lambda b: b["block_order"]), len(order) + 1
            else:
                found = None
                for at in range(cursor, len(order)):
                    b = order[at]
                    if b["block_id"] in used or not fits(b) or (b["type"] == "figure" and b["attached_to"]):
                        continue
                    if b["type"] in EXPECTED.get(it["item_type"], ()) or b["type"] in ALWAYS or words & _set(b["tokens"]) or (head and head in (b["text"] or "")) or (b["type"] == "figure" and b["has_image"]):
                        found = at
                        break
                if found is None:
                    continue
                held, targets, room = [order[found]], [order[found]], max_blocks
                used.add(order[found]["block_id"])
                cursor = found + 1
            for target in targets:
                for b in sorted(attached.get(target["block_id"], []), key=lambda b: b["block_id"]):
                    if b["block_id"] not in used and len(held) < room:
                        held.append(b)
                        used.add(b["block_id"])
            while not own and cursor < len(order) and len(held) < max_blocks:
                b = order[cursor]
                if b["block_id"] in used:
                    cursor += 1
                elif b["type"] == "figure" and b["has_image"] and not b["attached_to"] and fits(b):
                    held.append(b)
                    used.add(b["block_id"])
                    cursor += 1
                else:
                    break
            rows += [(it["doc_id"], it["item_id"], b["block_id"], n, b["page_index"]) for n, b in enumerate(held)]
        return pd.DataFrame(rows, columns=["doc_id", "item_id", "block_id", "n", "page_index"])

    body = F.col("text") if "text" in items.columns else F.col("title")
    norm = T.structure_normalized(F.coalesce(body, F.lit(""))) if synthetic is not None else F.lit("")
    head = T.first_sentence(F.coalesce(body, F.lit(""))) if "text" in items.columns else F.col("title")
    left = items.select(F.col("doc_id").alias("doc_id"), "item_seq", "item_id", "item_type", head.alias("head"), "tokens", "chapter", norm.alias("norm"))
    names = ["doc_id", "chapter", "page_index", "block_order", "block_id", "type", "text", "tokens", "has_image", "attached_to"]
    right = blocks.select(*names, F.lit("").alias("norm"), F.lit(False).alias("made"))
    if synthetic is not None:
        said = F.coalesce("text", F.lit(""))
        made = synthetic.select("doc_id", F.coalesce(F.get("chapter_path", 0), F.lit("")).alias("chapter"), "page_index", F.col("line").alias("block_order"), "block_id", "type", "text", T.tokens(said).alias("tokens"), F.lit(False).alias("has_image"), F.lit(None).cast("string").alias("attached_to"), T.structure_normalized(said).alias("norm"), F.lit(True).alias("made"))
        right = right.unionByName(made)
    return left.groupBy("doc_id").cogroup(right.groupBy("doc_id")).applyInPandas(bind, BOUND)


def _set(words) -> set:
    return set() if words is None else set(words)


def _contained(it: dict, free: list[dict], fits) -> list[dict]:
    """The free blocks that hold the item's text or lie in it: by the shorter text, shared tokens, then the earlier line."""
    words = _set(it["tokens"])
    met = [b for b in free if it["norm"] and b["norm"] and fits(b) and (b["norm"] in it["norm"] or it["norm"] in b["norm"])]
    return sorted(met, key=lambda b: (min(len(b["norm"]), len(it["norm"])), len(words & _set(b["tokens"])), -b["block_order"]), reverse=True)


def synthetic_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks made of Markdown text that have a place in the layout, with chapter and section carried forward in the order of their lines.

    blocks: doc_id, block_id, block_type, heading_level, text, source_line_start, page_index, page_number.
    """
    level = F.when(F.coalesce("block_type", F.lit("paragraph")) == "heading", F.coalesce("heading_level", F.lit(0)))
    rows = carry_forward(blocks.withColumn("_level", level), "doc_id", ["source_line_start", "block_id"], level="_level")
    placed = rows.filter(F.col("page_index").isNotNull() & F.col("page_number").isNotNull())
    path = F.array_compact(F.array("chapter", "section"))
    return placed.select("doc_id", "block_id", F.coalesce("block_type", F.lit("paragraph")).alias("type"), "text", "page_index", "page_number", F.coalesce("source_line_start", F.lit(0)).alias("line"), path.alias("chapter_path"), T.first_sentence(F.coalesce("text", F.lit(""))).alias("text_signature"))


def contained_blocks(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, item_id, n, block_id: for each item in turn the unused blocks of its chapter whose text holds its text or lies in it.

    items: doc_id, item_seq, item_id, text, chapter. blocks: those of `synthetic_blocks`. Blocks of an item come by the shorter
    text's length, shared tokens and line, greatest first, an earlier line before a later one. What is used depends on the items
    before, so a document is one task of its own rows.
    """

    def bind(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free, rows = right.sort_values(["line", "block_id"]).to_dict("records"), []
        for it in left.sort_values("item_seq").to_dict("records"):
            words, ranked = set(it["tokens"]), []
            for b in free:
                if it["norm"] and b["norm"] and b["chapter"] in ("", it["chapter"]) and (b["norm"] in it["norm"] or it["norm"] in b["norm"]):
                    ranked.append(((min(len(b["norm"]), len(it["norm"])), len(words & set(b["tokens"])), -b["line"]), b))
            ranked.sort(key=lambda r: r[0], reverse=True)
            taken = {b["block_id"] for _, b in ranked}
            free = [b for b in free if b["block_id"] not in taken]
            rows += [(it["doc_id"], it["item_id"], n, b["block_id"]) for n, (_, b) in enumerate(ranked)]
        return pd.DataFrame(rows, columns=["doc_id", "item_id", "n", "block_id"])

    plain = lambda df: df.withColumns({"norm": T.structure_normalized(F.coalesce("text", F.lit(""))), "tokens": T.tokens(F.coalesce("text", F.lit("")))})
    left = plain(items).select("doc_id", "item_seq", "item_id", "norm", "tokens", F.coalesce("chapter", F.lit("")).alias("chapter"))
    right = plain(blocks).select("doc_id", "block_id", "line", "norm", "tokens", F.coalesce(F.get("chapter_path", 0), F.lit("")).alias("chapter"))
    kind = items.schema["doc_id"].dataType.simpleString()
    return left.groupBy("doc_id").cogroup(right.groupBy("doc_id")).applyInPandas(bind, f"doc_id {kind}, item_id string, n int, block_id string")


def resolve_figures(figures: DataFrame, assets: DataFrame, min_stem: int = 16) -> DataFrame:
    """figures (ref) with asset_id: by id, by URL, by a stem of min_stem characters in the URL, then by id prefix."""
    by_id = assets.select(F.col("asset_id").alias("ref"), F.col("asset_id").alias("a1"))
    by_url = assets.groupBy(F.col("source_url").alias("ref")).agg(F.max_by("asset_id", "ord").alias("a2"))
    out = figures.join(by_id, "ref", "left").join(by_url, "ref", "left")
    rest = out.filter(F.col("a1").isNull() & F.col("a2").isNull()).select("ref").distinct()
    stem = F.regexp_extract("ref", r"([^/]+?)(?:\.[^./]*)?$", 1)
    # a stem of that length is in a URL only where its first characters are, so both sides meet in an equal piece
    pieces = F.transform(F.sequence(F.lit(1), F.length("source_url") - min_stem + 1), lambda i: F.substring(F.col("source_url"), i, F.lit(min_stem)))
    cut = assets.filter(F.length("source_url") >= min_stem).withColumn("piece", F.explode(F.array_distinct(pieces)))
    stems = rest.withColumn("stem", stem).filter(F.length("stem") >= min_stem).withColumn("piece", F.substring("stem", 1, min_stem))
    met = stems.join(cut, "piece").filter(F.contains(F.col("source_url"), F.col("stem")))
    by_stem = met.groupBy("ref").agg(F.max_by("asset_id", F.struct(F.length("source_url"), -F.col("ord"))).alias("a3"))
    begins = rest.withColumn("asset_id", F.explode(F.transform(F.sequence(F.lit(1), F.length("ref")), lambda i: F.substring(F.col("ref"), F.lit(1), i))))
    by_prefix = begins.join(assets, "asset_id").groupBy("ref").agg(F.min_by("asset_id", "ord").alias("a4"))
    out = out.join(by_stem, "ref", "left").join(by_prefix, "ref", "left")
    return out.withColumn("asset_id", F.coalesce("a1", "a2", "a3", "a4")).drop("a1", "a2", "a3", "a4")


def nested_book(items: DataFrame) -> DataFrame:
    """One row a document: chapters > sections > items, keyed by title, in order of first appearance.

    items: doc_id, item_seq, item_id, item_type, title, chapter_path.
    """
    rows = items.withColumns({"chapter": F.coalesce(F.get("chapter_path", 0), F.lit("")), "section": F.coalesce(F.get("chapter_path", 1), F.lit("<root>"))})
    item = F.struct("item_seq", "item_id", "item_type", "title")
    sections = rows.groupBy("doc_id", "chapter", "section").agg(F.min("item_seq").alias("first"), F.array_sort(F.collect_list(item)).alias("items"))
    section = F.struct("first", F.col("section").alias("title"), "items")
    chapters = sections.groupBy("doc_id", "chapter").agg(F.min("first").alias("first"), F.array_sort(F.collect_list(section)).alias("sections"))
    chapter = F.struct("first", F.col("chapter").alias("title"), "sections")
    return chapters.groupBy("doc_id").agg(F.array_sort(F.collect_list(chapter)).alias("chapters"))
