"""Cut Markdown into typed items and blocks: line explode, running sums, carry-forward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import text as T

# Item markers and their types.
MARKERS = {
    "定义": "definition",
    "定理": "theorem", "性质": "theorem", "推论": "theorem", "命题": "theorem", "引理": "theorem", "公理": "theorem",
    "例题": "example", "例": "example",
    "习题": "exercise", "练习": "exercise",
    "解": "solution", "证明": "solution",
    "小结": "summary", "总结": "summary", "归纳": "summary",
    "方法": "method", "思路": "method",
    "考点": "knowledge_point", "知识点": "knowledge_point",
}
HEADING = r"(?U)^(#{1,4})\s+(.*)$"
MARKDOWN_HEADING = r"(?U)^(#{1,6})\s+(.*)$"
LISTED = r"(?U)^(?:[-*+•]\s+|\d+[.)、]\s*|[一二三四五六七八九十]+、)"
MARKER = r"(?U)^\*\*\s*(" + "|".join(sorted(MARKERS, key=len, reverse=True)) + r")\b"


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, line_no (from 0), line: without trailing white space; a final line break adds no line."""
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r\n?|[\u000b\u000c\u001c-\u001e\u0085  ]", "\n")
    cut = F.split(F.regexp_replace(body, r"\n\z", ""), "\n")
    rows = docs.select("doc_id", F.posexplode(cut).alias("line_no", "line"))
    return rows.withColumn("line", F.regexp_replace("line", r"(?U)\s+$", ""))


def extract_items(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, item_seq, item_id, item_type, title, text, chapter_path of each item.

    Headings of level 1 and 2 set chapter and section, of level 3 and 4 begin an item of type other; a marker line
    begins a typed item. Items without any text are dropped before numbering.
    """
    rows = lines(docs, text)
    level = F.length(F.regexp_extract("line", HEADING, 1))
    rows = rows.withColumns({"level": level, "head": T.strip(F.regexp_extract("line", HEADING, 2)), "mark": F.regexp_extract("line", MARKER, 1)})
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({"bucket": F.sum(F.when((F.col("level") > 0) | (F.col("mark") != ""), 1).otherwise(0)).over(w), "part": F.sum((F.col("level") == 1).cast("int")).over(w), "chapter": F.last(F.when(F.col("level") == 1, F.col("head")), ignorenulls=True).over(w)})
    ws = W.partitionBy("doc_id", "part").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("section", F.last(F.when(F.col("level") == 2, F.col("head")), ignorenulls=True).over(ws))
    kind = F.lit("other")
    for word, name in MARKERS.items():
        kind = F.when(F.col("mark") == word, name).otherwise(kind)
    kind = F.when(F.col("level") == 1, "chapter").when(F.col("level") == 2, "section").when(F.col("level") > 0, "other").when(F.col("mark") != "", kind).otherwise("other")
    opens = (F.col("level") > 0) | (F.col("mark") != "")
    title = F.when(F.col("level") > 0, F.col("head")).when(F.col("mark") != "", F.regexp_replace("line", r"(?U)^[*\s]+|[*\s]+$", ""))
    lead = F.struct("line_no", kind.alias("kind"), title.alias("title"), "chapter", "section")
    body = F.collect_list(F.when(~opens, F.struct("line_no", "line")))
    items = rows.groupBy("doc_id", "bucket").agg(F.min(F.when(opens, lead)).alias("lead"), F.array_sort(body).alias("body"), F.min(F.struct("line_no", "chapter", "section")).alias("any"))
    items = items.withColumn("body", T.strip(F.array_join(F.transform("body", lambda x: x["line"]), "\n")))
    title = F.coalesce(F.col("lead.title"), F.lit(""))
    items = items.filter((title != "") | (F.col("body") != ""))
    path = F.array_compact(F.array(F.coalesce("lead.chapter", "any.chapter"), F.coalesce("lead.section", "any.section")))
    seq = F.row_number().over(W.partitionBy("doc_id").orderBy("bucket"))
    return items.select("doc_id", seq.alias("item_seq"), F.format_string("item-%04d", seq).alias("item_id"), F.coalesce("lead.kind", F.lit("other")).alias("item_type"), title.alias("title"), F.when(F.col("body") == "", title).when(title == "", F.col("body")).otherwise(F.concat_ws("\n", title, F.col("body"))).alias("text"), path.alias("chapter_path"))


def text_blocks(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, block_no, first_line, last_line, kind, body: paragraphs and lists between blank lines."""
    rows = lines(docs, text)
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("gap", F.sum((F.col("line") == "").cast("int")).over(w)).filter("line != ''")
    blocks = rows.groupBy("doc_id", "gap").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("body"))
    listed = F.col("body").rlike(r"(?U)^\s*([-*+•]|\d+[.)、]|[一二三四五六七八九十]+[、.])\s*")
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("first_line"))
    return blocks.select("doc_id", number.alias("block_no"), "first_line", "last_line", F.when(listed, "list").otherwise("paragraph").alias("kind"), "body")


def markdown_blocks(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(blocks, images) of Markdown, lines counted from 1; a null text has neither.

    blocks: doc_id, block_id, block_type (heading, list or paragraph), text, heading_level, first_line, last_line. Blank lines and
    headings end a block; image markers are no text, and a line that holds nothing else neither adds to a block nor ends it.
    images: doc_id, line_no, k (from 0 in its line), target, of all lines but headings.
    """
    rows = lines(docs.filter(F.col(text).isNotNull()), text).withColumn("line_no", F.col("line_no") + 1)
    level = F.length(F.regexp_extract("line", MARKDOWN_HEADING, 1))
    image = "(?U)" + T.MARKDOWN_IMAGE
    rows = rows.withColumns({"level": level, "bare": F.when(level > 0, T.strip(F.regexp_extract("line", MARKDOWN_HEADING, 2))).otherwise(T.strip(F.regexp_replace("line", image, "")))})
    found = rows.filter("level = 0").select("doc_id", "line_no", F.posexplode(F.regexp_extract_all("line", F.lit(image), F.lit(0))).alias("k", "mark"))
    target = F.coalesce(F.nullif(F.regexp_extract("mark", image, 1), F.lit("")), F.regexp_extract("mark", image, 2))
    w = W.partitionBy("doc_id").orderBy("line_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("gap", F.sum(((F.col("level") > 0) | (F.col("line") == "")).cast("int")).over(w)).filter("bare <> ''")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "bare"))), lambda x: x["bare"]), "\n")
    made = rows.groupBy("doc_id", "gap", "level").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), body.alias("text"))
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("first_line"))
    kind = F.when(F.col("level") > 0, "heading").when(F.col("text").rlike(LISTED), "list").otherwise("paragraph")
    blocks = made.select("doc_id", F.format_string("md-b%06d", number).alias("block_id"), kind.alias("block_type"), "text", F.when(F.col("level") > 0, F.col("level")).alias("heading_level"), "first_line", "last_line")
    return blocks, found.select("doc_id", "line_no", "k", target.alias("target"))


def carry_forward(blocks: DataFrame, key: str, order: list[str], level: str = "level", text: str = "text") -> DataFrame:
    """blocks with chapter and section: the latest heading of level 1, and of level 2 since that."""
    w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = blocks.withColumns({"_part": F.sum(F.when(F.col(level) == 1, 1).otherwise(0)).over(w), "chapter": F.last(F.when(F.col(level) == 1, F.col(text)), ignorenulls=True).over(w)})
    ws = W.partitionBy(key, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return out.withColumn("section", F.last(F.when(F.col(level) == 2, F.col(text)), ignorenulls=True).over(ws)).drop("_part")


def page_blocks(pages: DataFrame) -> DataFrame:
    """page_id, block_order, tag, text of the headings, paragraphs and list items of HTML pages."""
    found = F.regexp_extract_all("html", F.lit(r"(?s)<(?:h1|p|li)>.*?</(?:h1|p|li)>"), 0)
    rows = pages.select("page_id", F.posexplode(found).alias("block_order", "raw"))
    return rows.select("page_id", "block_order", F.regexp_extract("raw", "^<(h1|p|li)>", 1).alias("tag"), F.regexp_replace("raw", "<[^>]*>", "").alias("text"))
