"""Named queries of reports, answers, the inbox, references, anchors and the planner."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import boxes
from leafmill.functions import text as T
from leafmill.operators import answers, binding, facts, media, planning, quality, reports, segment, structure
from leafmill.plans.catalogue import LINES_SQL, query, table
from leafmill.sources import inbox

KINDS_SQL = "CASE event_id % 4 WHEN 0 THEN 'parent_heading' WHEN 1 THEN 'caption_for' ELSE 'attached_to' END"


def _sorted_map(rows: str, name: str, n: str) -> str:
    return f"array_to_string(list({name} || '=' || {n} ORDER BY {name}), ',') FROM {rows}"


def _flat(m):
    """A map as text, by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")


@query(f"SELECT doc_id, {_sorted_map(f'(SELECT user_id AS doc_id, {KINDS_SQL} AS kind, count(*) AS n FROM events GROUP BY ALL)', 'kind', 'n')} GROUP BY doc_id".replace("array_to_string(list(kind || '=' || n ORDER BY kind), ',') FROM", "array_to_string(list(kind || '=' || n ORDER BY kind), ',') AS kinds FROM"))
def relation_kind_counts(spark, d):
    m = F.col("event_id") % 4
    edges = table(spark, d, "events").select(F.col("user_id").alias("doc_id"), F.when(m == 0, "parent_heading").when(m == 1, "caption_for").otherwise("attached_to").alias("kind"))
    return reports.relation_counts(edges).select("doc_id", _flat(F.col("kinds")).alias("kinds"))


@query("SELECT (SELECT count(DISTINCT user_id) FROM events) AS figures_total, (SELECT count(DISTINCT user_id) FROM events WHERE event_id % 3 = 0) AS figures_with_relations, (SELECT count(*) FROM events WHERE event_id % 3 = 0) AS relations_total, (SELECT array_to_string(list(event_type || '=' || n ORDER BY event_type), ',') FROM (SELECT event_type, count(*) AS n FROM events WHERE event_id % 3 = 0 GROUP BY 1)) AS evidence_counts")
def geometry_report(spark, d):
    ev = table(spark, d, "events")
    rels = ev.filter("event_id % 3 = 0").select(F.col("user_id").alias("figure_id"), F.col("event_type").alias("evidence"))
    out = reports.geometry_report(ev.select(F.col("user_id").alias("figure_id")).distinct(), rels)
    return out.withColumn("evidence_counts", _flat(F.col("evidence_counts")))


@query("WITH c AS (SELECT CASE event_id % 5 WHEN 0 THEN 'skipped' WHEN 1 THEN 'failed' WHEN 2 THEN 'rejected' WHEN 3 THEN 'ok' ELSE '' END AS status, CASE WHEN event_id % 7 > 0 THEN event_type END AS why FROM events) SELECT count(*) AS total, count(*) FILTER (status NOT IN ('skipped', '')) AS called, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'rejected') AS rejected, (SELECT array_to_string(list(why || '=' || n ORDER BY why), ',') FROM (SELECT why, count(*) AS n FROM c WHERE status = 'skipped' AND why IS NOT NULL GROUP BY 1)) AS skip_reasons FROM c")
def call_summary(spark, d):
    m = F.col("event_id") % 5
    status = F.when(m == 0, "skipped").when(m == 1, "failed").when(m == 2, "rejected").when(m == 3, "ok").otherwise("")
    calls = table(spark, d, "events").select(status.alias("status"), F.when(F.col("event_id") % 7 > 0, F.col("event_type")).alias("skip_reason"))
    return reports.call_summary(calls).withColumn("skip_reasons", _flat(F.col("skip_reasons")))


@query("SELECT CASE WHEN toxic = 1 THEN 'decor' WHEN quality = 1 THEN 'content' ELSE 'ambiguous' END AS role, count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM labels), 1) AS percent FROM labels GROUP BY 1")
def role_distribution(spark, d):
    role = F.when(F.col("toxic") == 1, "decor").when(F.col("quality") == 1, "content").otherwise("ambiguous")
    return reports.role_distribution(table(spark, d, "labels").select(role.alias("role")))


@query("""WITH c AS (SELECT doc_id % 300 AS k, contains(text, 'the') AS phrase, n_chars * len(string_split(text, chr(10))) < 10000 AS tiny, greatest(n_chars, len(string_split(text, chr(10)))) / least(n_chars, len(string_split(text, chr(10)))) > 5 AS aspect FROM documents)
    SELECT 'phrase' AS rule_id, count(*) FILTER (phrase) AS hits, count(*) FILTER (NOT phrase) AS defers, 0 AS saved_calls, false AS approved FROM c UNION ALL SELECT 'tiny', count(*) FILTER (tiny), count(*) FILTER (NOT tiny), count(DISTINCT k) FILTER (tiny), true FROM c UNION ALL SELECT 'aspect', count(*) FILTER (NOT tiny AND aspect), count(*) FILTER (NOT tiny AND NOT aspect), count(DISTINCT k) FILTER (NOT tiny AND aspect), true FROM c""")
def prefilter_report(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", F.col("n_chars").alias("w"), F.size(F.split("text", "\n")).alias("h"))
    got = quality.first_approved(quality.image_rules(F.col("text"), F.col("w"), F.col("h"), ["the"]), ["tiny", "aspect"])
    return reports.rule_report(rows.select("doc_id", *[c.alias(k) for k, c in got.items()]), ["tiny", "aspect"], F.col("doc_id") % 300)


@query("SELECT count(DISTINCT doc_id) AS items, count(DISTINCT doc_id) FILTER (lang <> 'en') AS classified, count(DISTINCT doc_id) FILTER (lang = 'en') AS unclassified, round(avg((lang = 'en')::INT), 6) AS share FROM documents")
def match_report(spark, d):
    topic = F.when(F.col("lang") == "en", "_misc").otherwise(F.col("lang"))
    return reports.match_report(table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), topic.alias("topic_id")))


@query("SELECT doc_id AS item_id FROM documents WHERE lang = 'en'")
def unclassified_items(spark, d):
    topic = F.when(F.col("lang") == "en", "_misc").otherwise(F.col("lang"))
    return reports.unclassified(table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), topic.alias("topic_id")))


@query("SELECT conv_id AS plan_id, CASE turn % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'dropped' ELSE 'blocked' END AS style, count(DISTINCT role) AS figures, count(*) AS uses FROM conversations WHERE turn % 4 < 3 GROUP BY ALL")
def dropped_figures(spark, d):
    m = F.col("turn") % 4
    lines = table(spark, d, "conversations").select(F.col("conv_id").alias("plan_id"), F.when(m == 0, "missing").when(m == 1, "dropped").when(m == 2, "blocked").otherwise("figure").alias("style"), F.col("role").alias("content"))
    return reports.dropped_figures(lines)


@query("SELECT user_id AS figure_id, '## ' || user_id || chr(10) || string_agg('- [unreviewed] ' || key || ' (' || event_type || ')', chr(10) ORDER BY key) AS entry FROM (SELECT DISTINCT user_id, event_type, 'kind::' || event_type AS key FROM events) GROUP BY user_id")
def review_queue(spark, d):
    rels = table(spark, d, "events").select(F.col("user_id").alias("figure_id"), F.concat(F.lit("kind::"), "event_type").alias("key"), F.col("event_type").alias("evidence"), F.lit("unreviewed").alias("review_state")).distinct()
    return reports.review_queue(rels)


@query("""SELECT event_id, CASE event_id % 6 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 4 THEN 0 WHEN 0 THEN 0 WHEN 5 THEN 0 ELSE 1 END AS n, CASE event_id % 6 WHEN 0 THEN 'empty response' WHEN 2 THEN 'discarded 2 invalid relation(s)' WHEN 4 THEN 'discarded 1 invalid relation(s)' WHEN 5 THEN 'response is not a JSON object' ELSE '' END AS error,
    CASE WHEN event_id % 6 IN (1, 2, 3) THEN upper(event_type) || '+CD' END AS names, CASE event_id % 6 WHEN 1 THEN least(1, greatest(0, value)) WHEN 2 THEN 0 WHEN 3 THEN 0.5 END::DOUBLE AS confidence FROM events""")
def answers_parsed(spark, d):
    rel = lambda kind, conf, more="": F.concat(F.lit('{"type":"' + kind + '","entities":[" '), "event_type", F.lit(' ","cd",null,""],"confidence":'), conf, F.lit("}" + more))
    whole = lambda body: F.concat(F.lit('{"relations":['), body, F.lit('],"observations":["seen"]}'))
    m = F.col("event_id") % 6
    raw = F.when(m == 0, F.lit("  ")).when(m == 1, F.concat(F.lit("```json\n"), whole(rel("parallel", F.col("value").cast("string"))), F.lit("\n```"))).when(m == 2, whole(rel("midpoint", F.lit("null"), ',7,{"type":"round","entities":["A"]}'))).when(m == 3, whole(rel("collinear", F.lit('" 0.5 "')))).when(m == 4, whole(rel("parallel", F.lit('"high"')))).otherwise(F.lit("[1, 2"))
    got = answers.parse_answers(table(spark, d, "events").select("event_id", raw.alias("raw")))
    first = F.get("relations", 0)
    return got.select("event_id", F.size("relations").alias("n"), "error", F.array_join(first["entities"], "+").alias("names"), first["confidence"].alias("confidence"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type || chr(10) || 'more' WHEN 1 THEN event_type ELSE '' END AS text FROM events")
def provider_text(spark, d):
    m, kind = F.col("event_id") % 6, F.col("event_type")
    blocks = F.concat(F.lit('{"content":[{"type":"text","text":"'), kind, F.lit('"},{"type":"image"},3,{"type":"text","text":"more"}]}'))
    plain = F.concat(F.lit('{"choices":[{"message":{"content":"'), kind, F.lit('"}}]}'))
    wrapped = F.concat(F.lit('{"data":'), plain, F.lit("}"))
    raw = F.when(m.isin(0, 3), blocks).when(m == 1, plain).when(m == 4, wrapped).when(m == 2, F.lit('{"choices":[]}')).otherwise(F.lit("no json"))
    text = F.when(m.isin(0, 3), answers.block_text(F.col("raw"))).otherwise(answers.choice_text(F.col("raw")))
    return table(spark, d, "events").withColumn("raw", raw).select("event_id", text.alias("text"))


@query("""SELECT user_id, sha256('[' || string_agg('{"asset_id":"' || event_type || '","context_hash":"' || event_id || '","height":' || (event_id % 9) || ',"note":' || CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '"é"' END || '}', ',' ORDER BY event_type, event_id::VARCHAR) || ']') AS inputs_hash FROM events GROUP BY 1""")
def inputs_hash(spark, d):
    rows = table(spark, d, "events").select("user_id", F.col("event_type").alias("asset_id"), F.col("event_id").cast("string").alias("context_hash"), (F.col("event_id") % 9).alias("height"), F.when(F.col("event_id") % 2 != 0, "é").alias("note"))
    return answers.inputs_hash(rows, "user_id", order=("asset_id", "context_hash"), columns=("asset_id", "context_hash", "height", "note"))


@query("""WITH m AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS tail, url FROM pages), u AS (SELECT url, max(page_id) AS p FROM m GROUP BY 1), n AS (SELECT tail, min(page_id) AS p FROM m GROUP BY 1 HAVING count(DISTINCT page_id) = 1 AND tail <> '')
    SELECT m.page_id AS doc_id, 'a ![x y](assets/' || u.p || '.png) b ![](' || CASE WHEN n.p IS NULL THEN 'images/' || m.tail ELSE 'assets/' || n.p || '.png' END || ') c ![z](nowhere/zz) d' AS text FROM m JOIN u USING (url) LEFT JOIN n ON n.tail = m.tail UNION ALL SELECT -1, 'no marks'""")
def rewrite_references(spark, d):
    pages = table(spark, d, "pages").filter(F.col("url").isNotNull())
    text = F.concat(F.lit("a ![x y]("), "url", F.lit(") b ![](images/"), media.tail(F.col("url")), F.lit(") c ![z](nowhere/zz) d"))
    docs = pages.select(F.col("page_id").alias("doc_id"), text.alias("text")).unionByName(spark.createDataFrame([(-1, "no marks")], "doc_id long, text string"))
    urls = pages.select("url", F.col("page_id").alias("asset_id"))
    return media.rewrite_references(docs, urls, pages.select(F.col("page_id").alias("asset_id"), F.lit("png").alias("suffix")))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'unsupported MIME type' WHEN doc_id % 4 = 1 THEN 'content too small' WHEN doc_id % 4 = 2 THEN 'not a decodable image' END AS problem FROM documents""")
def asset_validation(spark, d):
    k = F.col("doc_id") % 4
    mime = F.when(k == 0, "text/html").otherwise("image/png; charset=binary")
    png = F.unhex(F.lit("89504E470D0A1A0A"))
    content = F.when(k == 1, png).when(k == 2, F.concat(F.lit("GIF9"), F.repeat(F.lit("x"), 40)).cast("binary")).otherwise(F.concat(png, F.repeat(F.lit("x"), 40).cast("binary")))
    return table(spark, d, "documents").select("doc_id", quality.asset_problem(mime, content).alias("problem"))


@query("WITH r AS (SELECT user_id, event_id % 5 AS k, event_id % 3 = 0 AS there FROM events) SELECT user_id AS task_id, count(*) AS total, count(*) FILTER (k IN (0, 1)) AS remote, count(*) FILTER (k IN (2, 3)) AS local, count(*) FILTER (k IN (2, 3) AND there) AS resolved, count(*) FILTER (k = 1 OR k = 4 OR (k IN (2, 3) AND NOT there)) AS unreachable, CASE WHEN count(*) FILTER (k = 1 OR k = 4 OR (k IN (2, 3) AND NOT there)) > 0 THEN 'error' ELSE 'ok' END AS severity FROM r GROUP BY 1")
def image_reference_check(spark, d):
    k, ev = F.col("event_id") % 5, table(spark, d, "events")
    name = F.concat(F.lit("images/"), F.col("event_id").cast("string"), F.lit(".png"))
    ref = F.when(k == 0, F.concat(F.lit("https://x.org/"), "event_type")).when(k == 1, F.lit("http://a b.org/pic")).when(k < 4, name).otherwise(F.lit("C:/pic.png"))
    refs = ev.select(F.col("user_id").alias("task_id"), ref.alias("ref"))
    return inbox.check_references(refs, ev.filter("event_id % 3 = 0").select(F.col("user_id").alias("task_id"), name.alias("path")))


REFS = [("images/a.png", "images/a.png"), ("images/../b.png", "b.png"), ("images/../../etc", None), ("./c/./d.png", "c/d.png"), ("plain.png", "plain.png"), ("http://x/a", None), ("/etc/passwd", None), ("other/a.png", None), ("..", None), ("images/x/../../../y/images", None), ("./../z", None)]


@query("SELECT * FROM (VALUES {}) v(ref, path)".format(", ".join("('{}', {})".format(r, "NULL" if p is None else f"'{p}'") for r, p in REFS)))
def relative_references(spark, d):
    return spark.createDataFrame([(r,) for r, _ in REFS], "ref string").select("ref", inbox.local_reference(F.col("ref")).alias("path"))


@query("SELECT doc_id, regexp_replace(source || ' (é) ' || doc_id || '.v1.pdf', '[^\\p{L}\\p{N}.-]', '_', 'g') || '-' || CASE WHEN doc_id % 3 = 0 THEN 'noid' ELSE left(sha256(text), 12) END AS data_id, regexp_replace(source || ' (é) ' || doc_id || '.v1', '[^\\p{L}\\p{N}_-]', '_', 'g') || '-' || CASE WHEN doc_id % 3 = 0 THEN 'noid' ELSE left(sha256(text), 8) END AS task_id FROM documents")
def derived_ids(spark, d):
    name, sha = F.concat("source", F.lit(" (é) "), F.col("doc_id").cast("string"), F.lit(".v1.pdf")), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.sha2("text", 256))
    return table(spark, d, "documents").select("doc_id", inbox.data_id(name, sha).alias("data_id"), inbox.task_id(name, sha).alias("task_id"))


FILES_SQL = "SELECT user_id AS task_id, CASE event_id % 9 WHEN 0 THEN 'full.md' WHEN 1 THEN 'text.md' WHEN 2 THEN 'old.md' WHEN 3 THEN 'layout.json' WHEN 4 THEN 'blocks.json' WHEN 5 THEN 'main.tex' WHEN 6 THEN 'full.tex' WHEN 7 THEN 'notes.txt' ELSE 'full.html' END AS name, event_id FROM events WHERE event_id % 9 >= user_id % 4"
NAMES = ["full.md", "text.md", "old.md", "layout.json", "blocks.json", "main.tex", "full.tex", "notes.txt"]


def _files(spark, d):
    name = F.lit("full.html")
    for k, n in enumerate(NAMES):
        name = F.when(F.col("event_id") % 9 == k, n).otherwise(name)
    return table(spark, d, "events").filter("event_id % 9 >= user_id % 4").select(F.col("user_id").alias("task_id"), name.alias("name"), "event_id")


@query(f"WITH f AS ({FILES_SQL}), r AS (SELECT task_id, name, CASE WHEN name LIKE '%.md' THEN 'full.md' ELSE 'layout.json' END AS contract, CASE name WHEN 'full.md' THEN 0 WHEN 'layout.json' THEN 0 WHEN 'text.md' THEN 1 WHEN 'blocks.json' THEN 1 ELSE 2 END AS k FROM f WHERE name LIKE '%.md' OR name LIKE '%.json') SELECT task_id, contract, arg_min(name, k) AS name FROM r GROUP BY ALL")
def archive_names(spark, d):
    return inbox.contract_names(_files(spark, d), {"full.md": ("text.md", "old.md"), "layout.json": ("blocks.json",)})


@query(f"WITH f AS ({FILES_SQL}), p AS (SELECT DISTINCT task_id, CASE name WHEN 'full.md' THEN 'markdown' WHEN 'layout.json' THEN 'layout_json' WHEN 'full.html' THEN 'html' ELSE 'latex' END AS product, name FROM f WHERE name IN ('full.md', 'layout.json', 'full.html', 'full.tex', 'main.tex')), q AS (SELECT task_id, product, max(name) AS name FROM p GROUP BY ALL) SELECT t.task_id, 'my-book-' || t.task_id AS slug, coalesce(array_to_string(list(product || '=' || name ORDER BY product) FILTER (product IS NOT NULL), ','), '') AS products FROM (SELECT DISTINCT task_id FROM f) t LEFT JOIN q USING (task_id) GROUP BY 1")
def inbox_meta(spark, d):
    files = _files(spark, d).withColumn("original_filename", F.concat(F.lit("My (Book)! "), F.col("task_id").cast("string"), F.lit(".pdf")))
    return inbox.inbox_meta(files).select("task_id", "slug", F.coalesce(_flat(F.col("products")), F.lit("")).alias("products"))


@query("SELECT user_id AS task_id, sha256(string_agg('a/' || event_type || event_id || ':' || (event_id % 1000), chr(10) ORDER BY 'a/' || event_type || event_id)) AS fingerprint FROM events GROUP BY 1")
def folder_fingerprints(spark, d):
    return inbox.folder_fingerprint(table(spark, d, "events").select(F.col("user_id").alias("task_id"), F.concat(F.lit("a/"), "event_type", F.col("event_id").cast("string")).alias("path"), (F.col("event_id") % 1000).alias("length")))


@query("""WITH rec AS (SELECT doc_id % 500 AS f, 'a' || doc_id AS a, CASE WHEN quality = 1 THEN 'content' ELSE 'decor' END AS role FROM labels), tied AS (SELECT DISTINCT f::VARCHAR AS f, unnest([f::VARCHAR, a]) AS id FROM rec),
    ov AS (SELECT (event_id % 700)::VARCHAR AS f, arg_max(CASE WHEN event_id % 3 = 0 THEN 'content' ELSE 'decor' END, event_id) AS role FROM events WHERE event_id % 5 < 3 GROUP BY 1), said AS (SELECT coalesce(tied.id, ov.f) AS id, ov.role FROM ov LEFT JOIN tied USING (f)),
    base AS (SELECT DISTINCT unnest([f::VARCHAR, a]) AS id FROM rec WHERE role = 'content') SELECT id AS figure_id FROM base WHERE id NOT IN (SELECT id FROM said WHERE role = 'decor') UNION SELECT id FROM said WHERE role = 'content'""")
def content_figure_ids(spark, d):
    records = table(spark, d, "labels").select((F.col("doc_id") % 500).cast("string").alias("figure_id"), F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("asset_id"), F.when(F.col("quality") == 1, "content").otherwise("decor").alias("role"))
    k = F.col("event_id")
    overrides = table(spark, d, "events").select((k % 700).cast("string").alias("figure_id"), F.when(k % 5 >= 3, "ambiguous").when(k % 3 == 0, "content").otherwise("decor").alias("role"), k.alias("ord"))
    return planning.content_figures(records, overrides)


@query("""WITH r AS (SELECT user_id AS f, ['equal_length', 'parallel', 'perpendicular', 'midpoint', 'collinear', 'point_on_segment', 'equal_angle'][event_id % 7 + 1] AS type, event_id % 7 AS k, event_type || '、E' || (event_id % 4) AS names, list_sort([event_type, 'e' || (event_id % 4)]) AS low FROM events WHERE event_id % 3 < 2 AND event_id % 7 > 1), p AS (SELECT DISTINCT conv_id, turn AS f FROM conversations)
    SELECT conv_id AS plan_id, arg_min(type || '(' || names || ')', (k, type || '::' || array_to_string(low, '+'), type || '(' || names || ')')) AS text FROM p JOIN r USING (f) GROUP BY 1""")
def bridge_relation(spark, d):
    k = F.col("event_id")
    kind = F.get(F.array(*map(F.lit, facts.BRIDGE_ORDER)), (k % 7).cast("int"))
    rels = table(spark, d, "events").filter(k % 7 > 1).select(F.col("user_id").alias("figure_id"), kind.alias("type"), F.array("event_type", F.concat(F.lit("E"), (k % 4).cast("string"))).alias("entities"), F.when(k % 3 == 0, "confirmed").when(k % 3 == 1, "corrected").otherwise("unreviewed").alias("review_state"))
    rels = rels.withColumn("key", T.relation_key(F.col("type"), F.col("entities")))
    return facts.best_reviewed(table(spark, d, "conversations").select(F.col("conv_id").alias("plan_id"), F.col("turn").alias("figure_id")), rels)


@query("SELECT user_id, array_to_string(list(event_type ORDER BY place), ',') AS names FROM (SELECT user_id, event_type, min(event_id) AS place FROM events GROUP BY ALL) GROUP BY 1")
def first_use_order(spark, d):
    return planning.first_use(table(spark, d, "events"), "user_id", "event_id", "event_type").select("user_id", F.array_join("names", ",").alias("names"))


BLOCK_SQL = f"l AS ({LINES_SQL}), b AS (SELECT doc_id, line_no AS first_line, 'b' || line_no AS block_id, CASE WHEN line_no % 7 = 3 THEN 'heading' ELSE 'paragraph' END AS type FROM l WHERE line <> '' AND line_no % 5 > 0), m AS (SELECT doc_id, line_no FROM l WHERE line <> '' AND line_no % 5 = 0)"


@query(f"WITH {BLOCK_SQL}, h AS (SELECT m.doc_id, m.line_no, max(first_line) AS h FROM m JOIN b ON b.doc_id = m.doc_id AND b.type = 'heading' AND b.first_line <= m.line_no GROUP BY ALL), t AS (SELECT m.doc_id, m.line_no, max(first_line) AS t FROM m JOIN b ON b.doc_id = m.doc_id AND b.type <> 'heading' AND b.first_line <= m.line_no GROUP BY ALL) SELECT m.doc_id, m.line_no, 'b' || CASE WHEN t > coalesce(h, 0) THEN t ELSE h END AS target_id FROM m LEFT JOIN h USING (doc_id, line_no) LEFT JOIN t USING (doc_id, line_no) WHERE t > coalesce(h, 0) OR h IS NOT NULL")
def image_anchors(spark, d):
    rows = segment.lines(table(spark, d, "documents")).filter("line <> ''")
    n = F.col("line_no")
    blocks = rows.filter(n % 5 > 0).select("doc_id", F.concat(F.lit("b"), n.cast("string")).alias("block_id"), F.when(n % 7 == 3, "heading").otherwise("paragraph").alias("type"), n.alias("first_line"), n.alias("last_line"))
    return structure.image_anchors(rows.filter(n % 5 == 0).select("doc_id", "line_no"), blocks)


@query(f"WITH l AS (SELECT doc_id, line_no, CASE line_no % 4 WHEN 1 THEN '## ' || left(line, 8) WHEN 2 THEN 'see ![image](p' || (line_no % 3) || '.png) and ![image](q.png)' ELSE line END AS line FROM ({LINES_SQL})), h AS (SELECT doc_id, line_no, line, coalesce(last_value(CASE WHEN line_no % 4 = 1 THEN trim(left(line[4:], 8), ' ') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), '') AS heading FROM l) SELECT doc_id, 'p' || (line_no % 3) || '.png' AS path, arg_min(heading, line_no) AS heading FROM h WHERE line_no % 4 = 2 GROUP BY ALL")
def image_headings(spark, d):
    n = F.col("line_no")
    line = F.when(n % 4 == 1, F.concat(F.lit("## "), F.substring("line", 1, 8))).when(n % 4 == 2, F.concat(F.lit("see ![image](p"), (n % 3).cast("string"), F.lit(".png) and ![image](q.png)"))).otherwise(F.col("line"))
    return structure.heading_of_images(segment.lines(table(spark, d, "documents")).withColumn("line", line))


@query("WITH e AS (SELECT user_id % 50 AS doc_id, 'b' || event_id AS block_id, CASE WHEN event_id % 9 = 0 THEN 'heading' ELSE 'paragraph' END AS block_type, CASE WHEN event_id % 9 = 0 THEN event_id % 2 + 1 END AS level, event_type || event_id AS text, event_id AS line, event_id % 4 AS page FROM events), w AS (SELECT *, sum((level = 1)::INT) OVER (PARTITION BY doc_id ORDER BY line) AS part, last_value(CASE WHEN level = 1 THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS chapter FROM e), x AS (SELECT *, last_value(CASE WHEN level = 2 THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id, coalesce(part, 0) ORDER BY line ROWS UNBOUNDED PRECEDING) AS section FROM w) SELECT doc_id, block_id, block_type AS type, concat_ws('/', chapter, section) AS path FROM x WHERE page > 0")
def synthetic_blocks(spark, d):
    k = F.col("event_id")
    head = k % 9 == 0
    blocks = table(spark, d, "events").select((F.col("user_id") % 50).alias("doc_id"), F.concat(F.lit("b"), k.cast("string")).alias("block_id"), F.when(head, "heading").otherwise("paragraph").alias("block_type"), F.when(head, k % 2 + 1).cast("int").alias("heading_level"), F.concat("event_type", k.cast("string")).alias("text"), k.alias("source_line_start"), F.when(k % 4 > 0, k % 4).cast("int").alias("page_index"), F.when(k % 4 > 0, k % 4 + 1).cast("int").alias("page_number"))
    return binding.synthetic_blocks(blocks).select("doc_id", "block_id", "type", F.array_join("chapter_path", "/").alias("path"))


@query("SELECT event_id % 100 AS item_id, min(least(x0, x1)) AS x0, min(least(y0, y1)) AS y0, max(greatest(x0, x1)) AS x1, max(greatest(y0, y1)) AS y1, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS pages FROM (SELECT event_id, user_id, value AS x0, value * 2 - 30 AS x1, event_id % 77 AS y0, event_id % 13 AS y1 FROM events) GROUP BY 1")
def box_unions(spark, d):
    k, v = F.col("event_id"), F.col("value")
    box = F.array(v, v * 2 - 30, k % 77, k % 13)
    g = table(spark, d, "events").select((k % 100).alias("item_id"), "user_id", F.array(box[0], box[2].cast("double"), box[1], box[3].cast("double")).alias("box"))
    out = g.groupBy("item_id").agg(boxes.union_box(F.col("box")).alias("b"), F.sort_array(F.collect_set("user_id")).alias("p"))
    return out.select("item_id", *[F.get("b", i).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], F.array_join("p", ",").alias("pages"))


@query("SELECT user_id AS item_id, arg_min(event_type, event_id) AS asset_id FROM events GROUP BY 1 HAVING arg_min(event_id, event_id) % 5 > 0")
def figure_items(spark, d):
    k = F.col("event_id")
    rows = table(spark, d, "events").select(F.col("user_id").alias("item_id"), k.alias("ord"), F.when(k % 5 > 0, F.array("event_type", F.lit("other"))).otherwise(F.array().cast("array<string>")).alias("asset_refs"))
    return facts.figure_items(rows)
