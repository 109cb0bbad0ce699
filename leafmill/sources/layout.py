"""Readers of OCR results: inbox folders, Markdown, layout JSON in two shapes, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SPAN = "array<struct<type:string,content:string,image_path:string,bbox:array<double>>>"
PDF_INFO = f"array<struct<page_idx:int,para_blocks:array<struct<type:string,text:string,bbox:array<double>,blocks:array<struct<bbox:array<double>,lines:array<struct<bbox:array<double>,spans:{_SPAN}>>>>>>>>"
PAGES = "array<struct<page_index:int,page_number:int,blocks:array<struct<block_id:string,type:string,level:int,bbox:array<double>,text:string,image_url:string,asset_id:string,caption:string,labels:array<string>>>>>"
LAYOUT = f"pages {PAGES}, pdf_info {PDF_INFO}"


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """path, text of whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of layout files of either shape, by file path."""
    raw = spark.read.schema(LAYOUT).json(path, multiLine=True).withColumn("doc_id", F.col("_metadata.file_path"))
    return layout_blocks(raw)


def layout_blocks(raw: DataFrame) -> DataFrame:
    """raw (doc_id, pages, pdf_info) -> one row a block; a document with neither shape fails the query."""
    native = F.coalesce("pdf_info", F.raise_error(F.lit("layout has neither pages nor pdf_info")).cast(PDF_INFO))
    plain = raw.filter(F.col("pages").isNotNull()).select("doc_id", F.posexplode("pages").alias("page_pos", "page"))
    plain = plain.select("doc_id", F.coalesce("page.page_index", "page_pos").alias("page_index"), F.coalesce(F.nullif("page.page_number", F.lit(0)), F.coalesce("page.page_index", "page_pos") + 1).alias("page_number"), F.posexplode("page.blocks").alias("block_order", "b"))
    plain = plain.select("doc_id", "page_index", "page_number", "block_order", F.coalesce(F.nullif("b.block_id", F.lit("")), F.format_string("p%03d-b%03d", "page_index", "block_order")).alias("block_id"), F.coalesce(F.nullif("b.type", F.lit("")), F.lit("paragraph")).alias("type"), "b.level", "b.bbox", "b.text", "b.image_url", "b.asset_id", "b.caption", "b.labels")
    return plain.unionByName(adapt_native(raw.filter(F.col("pages").isNull()).withColumn("pdf_info", native)), allowMissingColumns=True)


def adapt_native(raw: DataFrame) -> DataFrame:
    """The OCR tool's own pdf_info shape -> blocks; empty blocks are dropped after numbering."""
    rows = raw.select("doc_id", F.explode("pdf_info").alias("p")).select("doc_id", F.col("p.page_idx").alias("page_index"), F.posexplode("p.para_blocks").alias("block_order", "b"))
    lines = F.flatten(F.transform(F.coalesce("b.blocks", F.array().cast("array<struct<bbox:array<double>,lines:array<struct<bbox:array<double>,spans:array<struct<type:string,content:string,image_path:string,bbox:array<double>>>>>>>")), lambda x: F.coalesce(x["lines"], F.array().cast(f"array<struct<bbox:array<double>,spans:{_SPAN}>>"))))
    rows = rows.withColumn("spans", F.flatten(F.transform(lines, lambda x: F.coalesce(x["spans"], F.array().cast(_SPAN)))))
    picture = F.get(F.filter("spans", lambda s: s["image_path"].isNotNull() & (s["image_path"] != "")), 0)
    words = F.array_join(F.filter(F.transform("spans", lambda s: F.trim(F.coalesce(s["content"], F.lit("")))), lambda x: x != ""), " ")
    rows = rows.withColumns({"text": F.coalesce(F.nullif("b.text", F.lit("")), words), "pic": picture})
    kind = F.when(F.col("b.type") == "image", "figure").when(F.col("b.type") == "title", "heading").otherwise("paragraph")
    rows = rows.withColumn("type", kind).filter((F.col("text") != "") | (F.col("type") == "figure"))
    return rows.select("doc_id", "page_index", (F.col("page_index") + 1).alias("page_number"), "block_order", F.format_string("p%03d-b%03d", "page_index", "block_order").alias("block_id"), "type", F.coalesce("pic.bbox", "b.bbox").alias("bbox"), "text", F.col("pic.image_path").alias("image_url"))


def scan_inbox(spark: SparkSession, root: str) -> DataFrame:
    """task_id, path, name of files of the tasks below root; folders _processing and _archive are not tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    parts = F.split("path", "/")
    out = files.select("path", "length", F.element_at(parts, -1).alias("name"), F.regexp_extract("path", f"{root.rstrip('/').split('/')[-1]}/([^/]+)/", 1).alias("task_id"))
    return out.filter(~F.col("task_id").isin("_processing", "_archive", ""))


def inbox_problems(files: DataFrame) -> DataFrame:
    """task_id, problem: tasks without meta.json or without Markdown."""
    g = files.groupBy("task_id").agg(F.max((F.col("name") == "meta.json").cast("int")).alias("meta"), F.max(F.col("name").endswith(".md").cast("int")).alias("md"))
    found = F.array_compact(F.array(F.when(F.col("meta") == 0, "missing meta.json"), F.when(F.col("md") == 0, "missing markdown product")))
    return g.select("task_id", F.explode(found).alias("problem"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, width, height, bytes, magic of image files; width is -1 where Spark cannot decode one."""
    from leafmill.operators.quality import magic_of

    place = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    raw = spark.read.format("binaryFile").load(path).select(place("path").alias("path"), F.col("length").alias("bytes"), magic_of(F.col("content")).alias("magic"))
    seen = spark.read.format("image").load(path).select(place("image.origin").alias("path"), "image.width", "image.height")
    return raw.join(seen, "path", "left")


def links(html: Column) -> Column:
    """Distinct href and src targets of an HTML text."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit("(?:href|src)=\"([^\"]*)\""), 1))
