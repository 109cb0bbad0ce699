"""More named queries: scalar functions, gates, resolution, merges, plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import facts, media, planning, quality, structure
from leafmill.plans import stages
from leafmill.plans.catalogue import NAME_SQL, TAIL_SQL, query, table


@query(f"SELECT page_id, {NAME_SQL} AS name, url_decode(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')) AS path, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM (SELECT page_id, replace(replace(url, '/en/', '/e%6E%20/'), '/fr/', '/%66r/') AS url FROM pages)")
def url_parts(spark, d):
    odd = F.replace(F.replace("url", F.lit("/en/"), F.lit("/e%6E%20/")), F.lit("/fr/"), F.lit("/%66r/"))
    pages = table(spark, d, "pages").select("page_id", odd.alias("url"))
    return pages.select("page_id", T.basename(F.col("url")).alias("name"), T.url_path(F.col("url")).alias("path"), T.slug(F.col("url")).alias("slug"))


@query("SELECT doc_id, 'fig-' || left(sha1(source || '|' || doc_id), 12) AS figure_id, 'pair::' || array_to_string(list_sort([lower(source), lower(lang)]), '+') AS key, CASE WHEN regexp_matches(text, '[㐀-鿿]') THEN 'zh' ELSE 'en' END AS locale, coalesce(TRY_CAST(nullif(regexp_extract(source, '(\\d+)', 1), '') AS BIGINT), 1000000000) AS source_order FROM documents")
def stable_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", T.short_hash(F.col("source"), F.col("doc_id")).alias("figure_id"), T.relation_key(F.lit("pair"), F.array("source", "lang")).alias("key"), T.locale_of(F.col("text")).alias("locale"), T.source_order(F.col("source")).alias("source_order"))


@query("SELECT event_id, least(1, greatest(0, CASE WHEN event_id % 9 = 0 THEN 0 ELSE value / 100 END))::DOUBLE AS confidence, CASE WHEN event_id % 3 = 0 THEN 'content' WHEN event_id % 3 = 1 THEN 'decor' ELSE 'ambiguous' END AS role FROM events")
def coerced_answers(spark, d):
    raw = F.when(F.col("event_id") % 9 == 0, "nan").otherwise((F.col("value") / 100).cast("string"))
    said = F.when(F.col("event_id") % 3 == 0, " Content ").when(F.col("event_id") % 3 == 1, "DECOR").otherwise("banner?")
    return table(spark, d, "events").select("event_id", T.confidence(raw).alias("confidence"), T.role(said).alias("role"))


@query("SELECT doc_id, '[source: ' || source || ']' || chr(10) || '[lang: ' || lang || ']' AS block, lang AS read_back FROM documents")
def meta_blocks(spark, d):
    rows = table(spark, d, "documents").select("doc_id", T.meta_block(source=F.col("source"), empty=F.lit(""), lang=F.col("lang")).alias("block"))
    return rows.withColumn("read_back", T.meta_field(F.col("block"), "lang"))


@query("SELECT d.doc_id, b.item_id, substr(d.text, greatest(1, position(b.text IN d.text) - 50), position(b.text IN d.text) - greatest(1, position(b.text IN d.text) - 50) + length(b.text) + 50) AS context FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def local_context(spark, d):
    phrases = table(spark, d, "benchmark").select("item_id", F.col("text").alias("phrase"))
    met = media.holding(table(spark, d, "documents").select("doc_id", "text"), phrases, "text", "phrase")
    return met.select("doc_id", "item_id", T.local_context(F.col("text"), F.col("phrase"), 50).alias("context"))


@query("""WITH a AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'a.png' WHEN 1 THEN 'a.jpg' WHEN 2 THEN 'a.txt' ELSE 'a.webp' END AS path, page_id % 5 <> 0 AS present, page_id * 100000 AS bytes, page_id % 7 AS width, 4000000 AS height, CASE WHEN page_id % 11 = 0 THEN NULL ELSE 'png' END AS magic FROM pages)
    SELECT page_id, CASE WHEN path = 'a.txt' THEN 'suffix' WHEN NOT present THEN 'missing' WHEN bytes > 10000000 THEN 'too_many_bytes' WHEN magic IS NULL OR width <= 0 THEN 'undecodable' WHEN path <> 'a.png' THEN 'suffix_differs' WHEN width * height > 25000000 THEN 'too_many_pixels' END AS verdict FROM a""")
def asset_gate(spark, d):
    k = F.col("page_id")
    path = F.when(k % 4 == 0, "a.png").when(k % 4 == 1, "a.jpg").when(k % 4 == 2, "a.txt").otherwise("a.webp")
    verdict = quality.asset_gate(path, k % 5 != 0, k * 100000, k % 7, F.lit(4_000_000), F.when(k % 11 != 0, "png"))
    return table(spark, d, "pages").select("page_id", verdict.alias("verdict"))


@query("""WITH r AS (SELECT user_id, count(*) FILTER (event_id % 4 > 0 AND user_id % 9 > 0) AS n, count(*) FILTER (event_id % 4 > 0 AND user_id % 9 > 0 AND user_id % 4 > 0) AS firm, min(event_id % 10) FILTER (event_id % 4 > 0) AS low FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN n = 0 AND user_id % 2 = 0 THEN 'rules_blank' WHEN n = 0 THEN 'rules_blank_no_relations' WHEN firm = 0 THEN 'rules_only_non_promotable' WHEN low < 5 AND user_id % 5 > 0 THEN 'rules_low_confidence' WHEN user_id % 2 > 0 THEN 'rules_have_visual_observations' ELSE 'rules_sufficient' END AS reason, reason <> 'rules_sufficient' AS call FROM r""")
def model_gate(spark, d):
    k, u = F.col("event_id"), F.col("user_id")
    row = F.struct(F.when(u % 4 > 0, "problem_text").otherwise("unknown").alias("evidence"), F.when(u % 5 > 0, (k % 10) / 10).otherwise(F.lit(0.9)).alias("confidence"))
    rels = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.when((k % 4 > 0) & (u % 9 > 0), row)).alias("r"))
    gate = quality.model_gate(F.col("r"), F.when(u % 2 > 0, F.array(F.lit("seen"))).otherwise(F.array().cast("array<string>")))
    return rels.select("user_id", gate["reason"].alias("reason"), gate["call"].alias("call"))


@query(f"""WITH n AS (SELECT {TAIL_SQL} AS name, min(page_id) AS page_id, count(DISTINCT page_id) AS k FROM pages GROUP BY 1), r AS (SELECT page_id AS ref_id, CASE WHEN page_id % 3 = 0 THEN url ELSE 'local/' || {TAIL_SQL} END AS url FROM pages), u AS (SELECT url, max(page_id) AS page_id FROM pages GROUP BY 1)
    SELECT r.ref_id, coalesce(u.page_id, CASE WHEN n.k = 1 AND n.name <> '' THEN n.page_id END) AS page_id FROM r LEFT JOIN u ON u.url = r.url LEFT JOIN n ON n.name = {TAIL_SQL.replace('url', 'r.url')}""")
def resolve_references(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    refs = pages.select(F.col("page_id").alias("ref_id"), F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat(F.lit("local/"), media.tail(F.col("url")))).alias("ref"))
    return media.resolve(refs, pages, key="page_id", order="page_id").select("ref_id", "page_id")


@query("""WITH rules AS (SELECT DISTINCT user_id AS f, event_type AS t, user_id % 4 AS a, user_id % 3 AS b FROM events WHERE event_id % 2 = 0), model AS (SELECT event_id, user_id AS f, CASE WHEN event_id % 5 = 0 THEN 'other' ELSE event_type END AS t, user_id % 3 AS a, CASE WHEN event_id % 7 = 0 THEN 9 ELSE user_id % 4 END AS b FROM events)
    SELECT event_id, CASE WHEN EXISTS (SELECT 1 FROM rules r WHERE r.f = m.f AND r.t = m.t AND list_sort([r.a, r.b]) = list_sort([m.a, m.b])) THEN 'agree' WHEN EXISTS (SELECT 1 FROM rules r WHERE r.f = m.f AND list_sort(list_distinct([r.a, r.b])) = list_sort(list_distinct([m.a, m.b]))) THEN 'conflict' ELSE 'new' END AS verdict FROM model m""")
def merge_candidates(spark, d):
    ev = table(spark, d, "events")
    names = lambda a, b: F.array(a.cast("string"), b.cast("string"))
    rules = ev.filter("event_id % 2 = 0").select(F.col("user_id").alias("figure_id"), F.col("event_type").alias("type"), names(F.col("user_id") % 4, F.col("user_id") % 3).alias("entities")).distinct()
    model = ev.select("event_id", F.col("user_id").alias("figure_id"), F.when(F.col("event_id") % 5 == 0, "other").otherwise(F.col("event_type")).alias("type"), names(F.col("user_id") % 3, F.when(F.col("event_id") % 7 == 0, 9).otherwise(F.col("user_id") % 4)).alias("entities"))
    keyed = lambda x: x.withColumn("key", T.relation_key(F.col("type"), F.col("entities")))
    return facts.merge_candidates(keyed(rules), keyed(model)).select("event_id", "verdict")


@query("SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events WHERE event_id % 2 = 1 GROUP BY ALL UNION ALL SELECT user_id, event_type, arg_max(value, event_id) FROM events e WHERE event_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM events x WHERE x.event_id % 2 = 1 AND x.user_id = e.user_id AND x.event_type = e.event_type) GROUP BY ALL")
def keyed_upsert(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_type", "value", "event_id")
    base = quality.latest(ev.filter("event_id % 2 = 0"), ["user_id", "event_type"], [F.col("event_id")])
    return facts.upsert_last(base, ev.filter("event_id % 2 = 1"), ["user_id", "event_type"], "event_id").drop("event_id")


@query("WITH p AS (SELECT c_custkey AS k, c_nationkey AS n, lag(c_custkey) OVER (ORDER BY c_custkey) AS pk, lag(c_nationkey) OVER (ORDER BY c_custkey) AS pn FROM customer) SELECT 'p' || k AS plan_id, CASE WHEN n = pn OR k % 2 = 0 THEN 'outline' ELSE 'outline-fallback' END AS kind, CASE WHEN n = pn THEN 'shared: n' || n WHEN k % 2 = 0 THEN 'next: a, b' ELSE 't' || pk || ' -> t' || k END AS text FROM p WHERE pk IS NOT NULL AND k % 3 = 0")
def plan_bridges(spark, d):
    k = F.col("c_custkey")
    words = F.when(k % 2 == 0, F.array(F.lit("A"), F.lit("b"), F.lit("a"))).otherwise(F.array().cast("array<string>"))
    plans = table(spark, d, "customer").select(k.alias("plan_seq"), F.concat(F.lit("p"), k).alias("plan_id"), F.concat(F.lit("t"), k).alias("title"), F.when(k % 3 == 0, "C").otherwise("A").alias("mode"), F.array(F.concat(F.lit("n"), "c_nationkey"), F.concat(F.lit("leaf"), k)).alias("path"), words.alias("keywords"))
    return planning.bridges(plans)


@query("SELECT DISTINCT o.o_custkey AS item_id, l.l_partkey AS asset_id FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_partkey % 5 <> 0 AND l.l_quantity > 40 AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderkey % 200 + 1 = l.l_partkey)")
def figure_backfill(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    marks = li.filter("l_quantity > 40").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("item_id"), F.concat(F.lit("http://x/img/"), "l_partkey", F.lit(".png?v=1")).alias("target"))
    assets = table(spark, d, "part").filter("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("asset_id"), F.concat(F.lit("assets\\"), "p_partkey", F.lit(".png")).alias("local_path"), F.col("p_partkey").alias("ord"))
    existing = o.select(F.col("o_custkey").alias("item_id"), (F.col("o_orderkey") % 200 + 1).alias("asset_id")).distinct()
    return planning.backfill(marks, assets, existing)


@query("""WITH i AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'chapter' ELSE 'example' END AS kind, CASE WHEN c_custkey % 4 = 0 THEN '118' ELSE c_name END AS title FROM customer), own AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), m AS (SELECT i.*, own.k IS NOT NULL AS owns, title = '118' AS noise FROM i LEFT JOIN own USING (k))
    SELECT k::VARCHAR AS item_id, CASE WHEN noise OR kind = 'chapter' THEN '_misc' END AS topic_id, CASE WHEN noise THEN 'content_figure_on_noise_item' WHEN kind = 'chapter' THEN 'content_figure_on_intro_item' END AS reason, CASE WHEN noise AND k % 8 = 0 THEN '内容图（源页 ' || k || '）' WHEN noise THEN '内容图（' || k || '）' ELSE title END AS title, CASE WHEN noise THEN 'and more' ELSE title || ' and more' END AS text FROM m WHERE owns OR NOT (noise OR kind = 'chapter')""")
def content_rescue(spark, d):
    k = F.col("c_custkey")
    title = F.when(k % 4 == 0, "118").otherwise(F.col("c_name"))
    items = table(spark, d, "customer").select(k.cast("string").alias("item_id"), F.when(k % 3 == 0, "chapter").otherwise("example").alias("item_type"), title.alias("title"), F.concat(title, F.lit(" and more")).alias("text"), F.when(k % 8 == 0, F.array(k)).otherwise(F.array().cast("array<bigint>")).alias("pages"))
    o = table(spark, d, "orders")
    assets = o.select(F.col("o_custkey").cast("string").alias("item_id"), F.col("o_orderkey").alias("asset_id"))
    return planning.content_rescue(items, assets, o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("asset_id"))).select("item_id", "topic_id", "reason", "title", "text")


@query("SELECT user_id, count(*) AS n, CASE WHEN user_id % 10 = 0 THEN 'missing_markdown' WHEN user_id < 20 OR least(1, count(*) / user_id) >= 0.2 OR (user_id % 7) / 50 >= 0.1 THEN 'not_needed' WHEN user_id % 3 = 0 THEN 'unavailable_no_image_matches' ELSE 'active' END AS status FROM events GROUP BY user_id")
def alignment_gate(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    md = F.when(F.col("user_id") % 10 != 0, F.col("user_id") * 10)
    rows = g.select("user_id", "n", md.alias("markdown_chars"), (F.col("n") * 10).alias("layout_chars"), F.lit(50).alias("layout_blocks"), (F.col("user_id") % 7).alias("layout_text_blocks"), (F.col("user_id") % 3).alias("matched"))
    return structure.alignment_status(rows).select("user_id", "n", "status")


@query("WITH m AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k, turn AS line_no FROM conversations WHERE turn % 2 = 0), v AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k, turn AS block FROM conversations) SELECT conv_id, role, k, line_no, block FROM m JOIN v USING (conv_id, role, k)")
def paired_images(spark, d):
    c = table(spark, d, "conversations")
    md = c.filter("turn % 2 = 0").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("path"), F.col("turn").alias("line_no"))
    lay = c.select(F.col("conv_id").alias("doc_id"), F.col("role").alias("path"), F.lit(0).alias("page_index"), F.col("turn").alias("block_order"), F.col("turn").alias("block"))
    return structure.paired_images(md, lay).select(F.col("doc_id").alias("conv_id"), F.col("path").alias("role"), "k", "line_no", "block")


@query("SELECT user_id AS doc_id, sha256(string_agg(event_type || ':' || event_id, chr(10) ORDER BY event_type || ':' || event_id)) AS fingerprint FROM events GROUP BY 1")
def stage_fingerprints(spark, d):
    g = table(spark, d, "events").groupBy(F.col("user_id").alias("doc_id")).agg(F.collect_list(F.concat_ws(":", "event_type", "event_id")).alias("parts"))
    return g.select("doc_id", stages.fingerprint(F.col("parts")).alias("fingerprint"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'A' WHEN o_orderstatus <> 'O' OR o_orderkey % 2 = 0 THEN CASE o_orderstatus WHEN 'O' THEN 'B' ELSE 'C' END ELSE coalesce(CASE WHEN o_custkey % 3 = 0 THEN 'C' END, 'B') END AS mode FROM orders")
def effective_mode(spark, d):
    k, asked = F.col("o_orderkey"), F.when(F.col("o_orderstatus") == "O", "B").otherwise("C")
    mode = planning.effective_mode(asked, F.when(F.col("o_custkey") % 3 == 0, "C"), F.when(k % 11 == 0, "A"), k % 2 != 0)
    return table(spark, d, "orders").select("o_orderkey", mode.alias("mode"))
