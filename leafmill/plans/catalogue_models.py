"""Named queries of the Markdown alignment, the structure sidecar and the model calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import models, segment, structure
from leafmill.plans.catalogue import LINES_SQL, query, table

IMAGE_SQL = T.MARKDOWN_IMAGE.replace("'", "''")
TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
BLOCKS_SQL = f"""l AS ({LINES_SQL.replace("FROM documents", "FROM d")}), v AS (SELECT doc_id, line_no + 1 AS n, line, length(regexp_extract(line, '^(#{{1,6}})\\s+(.*)$', 1)) AS level FROM l),
    b AS (SELECT *, CASE WHEN level > 0 THEN {TRIM.format("regexp_extract(line, '^(#{1,6})\\s+(.*)$', 2)")} ELSE {TRIM.format(f"regexp_replace(line, '{IMAGE_SQL}', '', 'g')")} END AS bare, sum((level > 0 OR line = '')::INT) OVER (PARTITION BY doc_id ORDER BY n) AS gap FROM v),
    g AS (SELECT doc_id, gap, level, min(n) AS first_line, max(n) AS last_line, string_agg(bare, chr(10) ORDER BY n) AS text FROM b WHERE bare <> '' GROUP BY 1, 2, 3),
    k AS (SELECT doc_id, 'md-b' || lpad((row_number() OVER (PARTITION BY doc_id ORDER BY first_line))::VARCHAR, 6, '0') AS block_id, CASE WHEN level > 0 THEN 'heading' WHEN regexp_matches(text, '^(?:[-*+•]\\s+|\\d+[.)、]\\s*|[一二三四五六七八九十]+、)') THEN 'list' ELSE 'paragraph' END AS block_type, text, CASE WHEN level > 0 THEN level END AS heading_level, first_line, last_line FROM g),
    i AS (SELECT doc_id, n, level, unnest(regexp_extract_all(line, '{IMAGE_SQL}')) AS mark FROM v WHERE level = 0)"""


@query(f"WITH d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL), {BLOCKS_SQL} SELECT doc_id, block_id, block_type, heading_level, first_line, last_line, md5(text) AS digest FROM k")
def markdown_blocks(spark, d):
    blocks, _ = segment.markdown_blocks(table(spark, d, "documents"))
    return blocks.select("doc_id", "block_id", "block_type", "heading_level", "first_line", "last_line", F.md5(F.col("text").cast("binary")).alias("digest"))


TAIL = "\n\n![fig](<images/a{}.png>)\n# Part\n\n## Piece\nmore words\n\n### Deep\n![](b%20.png 'a title')\n- one"
ALIGNED_SQL = f"""WITH d AS (SELECT doc_id, text || '{TAIL.split("{}")[0].replace(chr(10), "' || chr(10) || '")}' || doc_id || '{TAIL.split("{}")[1].replace("'", "''").replace(chr(10), "' || chr(10) || '")}' AS text FROM documents), {BLOCKS_SQL},
    c AS (SELECT doc_id, text, length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{IMAGE_SQL}', '', 'g'), '\\[([^\\]]+)\\]\\([^)]+\\)', '\\1', 'g'), '[`*_~>#\\[\\]()]', '', 'g'), '\\s+', '', 'g')) AS chars, doc_id % 90 AS layout_chars, (doc_id % 13 = 0)::INT AS blocks FROM d),
    f AS (SELECT *, CASE WHEN text IS NULL THEN 'missing_markdown' WHEN chars < 200 THEN 'short' WHEN least(1, layout_chars / chars) >= 0.2 THEN 'covered' WHEN blocks / (blocks + 2) >= 0.1 THEN 'structured' WHEN doc_id % 3 = 0 AND doc_id % 2 = 1 THEN 'unavailable_no_image_matches' ELSE 'active' END AS why FROM c),
    a AS (SELECT i.doc_id, n AS line, CASE WHEN contains(mark, 'images/a') THEN 'v0' ELSE 'v1' END AS visual FROM i JOIN f USING (doc_id) WHERE why = 'active' AND ((contains(mark, 'images/a' || doc_id || '.png') AND doc_id % 3 > 0) OR (contains(mark, '(b%20.png') AND doc_id % 2 = 0)))"""


def _aligned(spark, d):
    text = F.concat("text", F.lit(TAIL.split("{}")[0]), F.col("doc_id").cast("string"), F.lit(TAIL.split("{}")[1]))
    docs = table(spark, d, "documents").select("doc_id", text.alias("text"))
    layout = docs.select("doc_id", (F.col("doc_id") % 90).alias("layout_chars"), (F.col("doc_id") % 13 == 0).cast("int").alias("layout_text_blocks"))
    path = F.when(F.col("ord") == 0, F.concat(F.lit("./images/a"), F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).otherwise(-1).cast("string"), F.lit(".png#x")))
    asset = F.when((F.col("ord") == 1) & (F.col("doc_id") % 2 == 0), F.lit("b%20")).otherwise("none")
    visuals = docs.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("ord")).select("doc_id", "ord", F.concat(F.lit("v"), "ord").alias("block_id"), F.col("ord").alias("page_index"), (F.col("ord") + 1).alias("page_number"), path.alias("path"), asset.alias("asset_id"))
    return structure.align(docs, layout, visuals)


@query(ALIGNED_SQL + """, m AS (SELECT doc_id, count(*) AS matched FROM a GROUP BY 1), p AS (SELECT doc_id, count(*) AS n FROM k GROUP BY 1), j AS (SELECT doc_id, count(*) AS images FROM i GROUP BY 1)
    SELECT f.doc_id, CASE WHEN why IN ('short', 'covered', 'structured') THEN 'not_needed' ELSE why END AS status, why, coalesce(chars, 0) AS markdown_chars, coalesce(images, 0) AS markdown_images, coalesce(matched, 0) AS matched, CASE WHEN why = 'active' THEN p.n ELSE 0 END AS synthetic_blocks,
    concat_ws(',', CASE WHEN why IN ('active', 'unavailable_no_image_matches') AND images > coalesce(matched, 0) THEN 'unmatched_markdown_images:' || (images - coalesce(matched, 0)) END, CASE WHEN why IN ('active', 'unavailable_no_image_matches') AND coalesce(matched, 0) < 2 THEN 'unmatched_layout_images:' || (2 - coalesce(matched, 0)) END) AS warnings FROM f LEFT JOIN m USING (doc_id) LEFT JOIN p USING (doc_id) LEFT JOIN j USING (doc_id)""")
def alignment_summary(spark, d):
    code = F.create_map(*[F.lit(x) for k, v in structure.ALIGNMENT_REASONS.items() for x in (v, k)])
    return _aligned(spark, d)["summary"].select("doc_id", "status", code[F.col("reason")].alias("why"), "markdown_chars", "markdown_images", "matched", "synthetic_blocks", F.array_join("warnings", ",").alias("warnings"))


@query(ALIGNED_SQL + """, x AS (SELECT doc_id, block_id, min(struct_pack(dist := greatest(0, line - last_line, first_line - line), behind := (line < last_line)::INT, line := line, visual := visual)) AS x FROM k JOIN a USING (doc_id) GROUP BY 1, 2)
    SELECT doc_id, block_id, x.visual AS anchor_block_id, CASE WHEN x.dist <= 2 THEN 0.9 ELSE 0.65 END::DOUBLE AS location_confidence FROM x""")
def aligned_blocks(spark, d):
    return _aligned(spark, d)["blocks"].select("doc_id", "block_id", "anchor_block_id", "location_confidence")


@query(ALIGNED_SQL + """, u AS (SELECT k.* FROM k WHERE doc_id IN (SELECT doc_id FROM a)), h AS (SELECT * FROM u WHERE heading_level IS NOT NULL),
    t AS (SELECT u.doc_id, u.block_id AS source_id, arg_max(h.block_id, h.first_line) AS target_id FROM u JOIN h ON h.doc_id = u.doc_id AND h.first_line < u.first_line AND (u.heading_level IS NULL OR h.heading_level < u.heading_level) GROUP BY 1, 2),
    y AS (SELECT a.doc_id, a.visual, a.line, coalesce(max(h.first_line), 0) AS top, arg_max(h.block_id, h.first_line) AS head FROM a LEFT JOIN h ON h.doc_id = a.doc_id AND h.first_line <= a.line GROUP BY 1, 2, 3),
    z AS (SELECT y.doc_id, y.visual, any_value(head) AS head, arg_max(u.block_id, u.last_line) AS near FROM y LEFT JOIN u ON u.doc_id = y.doc_id AND u.heading_level IS NULL AND u.first_line > top AND u.first_line <= line GROUP BY 1, 2)
    SELECT doc_id, 'parent_heading' AS kind, source_id, target_id, 1.0::DOUBLE AS confidence FROM t UNION ALL SELECT doc_id, 'attached_to', visual, coalesce(near, head), 0.85 FROM z WHERE coalesce(near, head) IS NOT NULL""")
def aligned_relations(spark, d):
    return _aligned(spark, d)["relations"].select("doc_id", "kind", "source_id", "target_id", "confidence")


@query("SELECT l_suppkey AS doc_id, l_partkey AS target_id, array_to_string(list_sort(list(DISTINCT 'v' || l_linenumber)), ',') AS sources FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL")
def attachments_by_target(spark, d):
    kind = F.when(F.col("l_returnflag") == "R", "attached_to").otherwise("caption_for")
    edges = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc_id"), kind.alias("kind"), F.concat(F.lit("v"), "l_linenumber").alias("source_id"), F.col("l_partkey").alias("target_id"))
    return structure.attachments_by_target(edges).select("doc_id", "target_id", F.array_join("sources", ",").alias("sources"))


PNG = "89504E470D0A1A0A"


def _answer(content: bytes, prompt: str) -> str:
    """A stand-in for a model: what it says depends on the bytes and the prompt alone."""
    if content.endswith(b"click"):
        raise OSError("no answer")
    context = prompt.rpartition(" ")[2]
    return {"0": '```json\n{"role": " Decor ", "confidence": 2, "reason": "r0"}\n```', "1": "no json", "2": '{"role": "odd", "confidence": "x"}'}.get(context, '{"role": "content", "confidence": 0.5, "reason": "r"}')


@query("""SELECT event_id AS figure_id, CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 AND event_id % 5 <> 4 OR event_type = 'click' AND event_id % 5 <> 4 THEN 'ambiguous' WHEN event_id % 5 = 4 THEN 'decor' WHEN event_id % 5 = 0 THEN 'decor' WHEN event_id % 5 = 3 THEN 'content' ELSE 'ambiguous' END AS role,
    CASE WHEN event_id % 11 = 0 THEN 'asset_unavailable' WHEN event_id % 5 = 4 THEN 'known' WHEN event_id % 7 = 0 THEN 'asset_rejected: suffix_differs' WHEN event_type = 'click' THEN 'provider_error' WHEN event_id % 5 = 0 THEN 'r0' WHEN event_id % 5 = 1 THEN 'schema_error' WHEN event_id % 5 = 2 THEN '' ELSE 'r' END AS reason,
    CASE WHEN event_id % 11 = 0 THEN 'skipped' WHEN event_id % 5 = 4 THEN 'cached' WHEN event_id % 7 = 0 THEN 'rejected' WHEN event_type = 'click' THEN 'failed' ELSE 'ok' END AS status FROM events""")
def annotated_roles(spark, d):
    ev = table(spark, d, "events")
    content = F.concat(F.unhex(F.lit(PNG)), F.col("event_type").cast("binary"))
    rows = ev.select(F.col("event_id").alias("figure_id"), F.col("user_id").alias("item_id"), F.col("event_type").alias("asset_id"), F.when(F.col("event_id") % 7 == 0, "a.webp").otherwise("a.png").alias("path"), F.when(F.col("event_id") % 11 > 0, content).alias("content"), F.lit(10).alias("width"), F.lit(10).alias("height"), (F.col("event_id") % 5).cast("string").alias("context"))
    cache = ev.select(content.alias("c")).distinct().select(models.role_key(F.sha2("c", 256), F.lit("4"), "m", "Which role? "), F.lit("decor").alias("role"), F.lit(0.5).alias("confidence"), F.lit("known").alias("reason")).toDF("key", "role", "confidence", "reason")
    records, _ = models.annotate(rows, _answer, cache, "Which role? ", "m", retries=0)
    return records.select("figure_id", "role", "reason", "status")


def _relations(content: bytes, prompt: str) -> str:
    return '{"relations": [{"type": "parallel", "entities": ["ab"], "confidence": 0.6}, {"type": "equal_length", "entities": ["AB"], "confidence": 0.4}, {"type": "collinear", "entities": ["X", "Y", "Z"], "confidence": 0.3}, {"type": "collinear", "entities": ["Z", "Y", "X"], "confidence": 0.9}], "observations": []}'


@query("""WITH r AS (SELECT event_id, unnest(CASE event_id % 4 WHEN 0 THEN ['parallel::ab problem_text'] WHEN 1 THEN ['parallel::ab visual_inference', 'equal_length::ab visual_inference', 'collinear::x+y+z visual_inference'] WHEN 2 THEN ['parallel::ab problem_text', 'parallel::cd problem_text'] ELSE ['parallel::ab diagram_mark'] END) AS x FROM events)
    SELECT event_id AS figure_id, split_part(x, ' ', 1) AS key, split_part(x, ' ', 2) AS evidence FROM r""")
def hybrid_relations(spark, d):
    m = F.col("event_id") % 4
    text = F.when(m == 0, "AB 平行").when(m == 1, "nothing here").when(m == 2, "AB ∥ CD").otherwise("see")
    figures = table(spark, d, "events").select(F.col("event_id").alias("figure_id"), text.alias("text"), F.when(m == 3, "AB 平行").otherwise("").alias("caption"), F.unhex(F.lit(PNG)).alias("content"))
    rels, _ = models.hybrid(figures, _relations, "Which relations? ", retries=0)
    return rels.select("figure_id", "key", "evidence")
