"""Named queries over the document tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import text as T
from leafmill.operators import facts, media, planning, quality, segment, structure, taxonomy
from leafmill.plans import stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------- text and segmentation

LINES_SQL = "SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, regexp_replace(unnest(l), '\\s+$', '') AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l FROM documents)"


@query(f"SELECT doc_id, line_no, length(line) AS n, md5(line) AS digest FROM ({LINES_SQL}) WHERE line <> ''")
def text_lines(spark, d):
    rows = segment.lines(table(spark, d, "documents")).filter("line <> ''")
    return rows.select("doc_id", "line_no", F.length("line").alias("n"), F.md5(F.col("line").cast("binary")).alias("digest"))


@query("""
    WITH l AS (%s), g AS (SELECT *, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS gap FROM l),
    b AS (SELECT doc_id, gap, min(line_no) AS first_line, max(line_no) AS last_line, string_agg(line, chr(10) ORDER BY line_no) AS body FROM g WHERE line <> '' GROUP BY ALL)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_line) AS block_no, first_line, last_line,
      CASE WHEN regexp_matches(body, '^\\s*([-*+•]|\\d+[.)、]|[一二三四五六七八九十]+[、.])\\s*') THEN 'list' ELSE 'paragraph' END AS kind, md5(body) AS digest FROM b
    """ % LINES_SQL)
def text_blocks(spark, d):
    rows = segment.text_blocks(table(spark, d, "documents"))
    return rows.select("doc_id", "block_no", "first_line", "last_line", "kind", F.md5(F.col("body").cast("binary")).alias("digest"))


@query("""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(list_sort(t), ' ')) AS digest FROM (
    SELECT doc_id, list_distinct(list_filter(string_split_regex(regexp_replace(text, '[^\\p{L}\\p{M}\\p{N}_]+', ' ', 'g'), ' +'), lambda x: length(x) >= 2)) AS t FROM documents)""")
def token_sets(spark, d):
    t = T.tokens(F.regexp_replace("text", r"[^\p{L}\p{M}\p{N}_]+", " "))
    return table(spark, d, "documents").select("doc_id", F.size(t).alias("n_tokens"), F.md5(F.array_join(F.array_sort(t), " ").cast("binary")).alias("digest"))


@query("SELECT doc_id, left(regexp_replace(string_split_regex(text, '[。！？!?.]')[1], '^\\s+|\\s+$', '', 'g'), 40) AS title FROM documents")
def first_sentence_title(spark, d):
    return table(spark, d, "documents").select("doc_id", T.first_sentence(F.col("text")).alias("title"))


MARKED = "text || chr(10) || '![' || source || '](x/' || doc_id || '.png) `' || lang || '` **B** ```' || chr(10) || 'code' || chr(10) || '``` End'"


@query(f"SELECT doc_id, md5(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({MARKED}, '!\\[([^\\]]*)\\]\\([^)]+\\)', '\\1', 'g'), '(?s)```.*?```', ' ', 'g'), '`[^`]*`', ' ', 'g'), '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'))) AS digest, length(text) > 0 AS some FROM documents")
def normalized_text(spark, d):
    rows = table(spark, d, "documents").withColumn("marked", F.concat("text", F.lit("\n!["), "source", F.lit("](x/"), F.col("doc_id").cast("string"), F.lit(".png) `"), "lang", F.lit("` **B** ```\ncode\n``` End")))
    return rows.select("doc_id", F.md5(T.normalized(F.col("marked")).cast("binary")).alias("digest"), (F.length("text") > 0).alias("some"))


NOISE_ROWS = [(1, "", ""), (2, "", "ab!"), (3, "学而思 课堂", "长文"), (4, "#", "x"), (5, "U", "U"), (6, "118", "118"), (7, "8-2", "8-2"), (8, "10", "10"), (9, "A1", "A1 short"), (10, "定义 三角形", "内容"), (11, "1234", "1234"), (12, "U", "a body that is long enough to be kept here")]
NOISE_VALUES = ", ".join(f"({i}, '{t}', '{b}')" for i, t, b in NOISE_ROWS)
NOISE_SQL = """
    SELECT id, CASE WHEN t = '' AND (b = '' OR (length(b) <= 3 AND NOT regexp_matches(b, '[\\p{L}\\p{N}]'))) THEN 'empty' WHEN t = '' THEN NULL
      WHEN regexp_matches(t, '微信公众号|教辅资料站|学而思|新东方|高思教育') THEN 'watermark'
      WHEN length(t) = 1 AND contains('#@$%&*?/\\|<>~^`', t) THEN 'symbol'
      WHEN regexp_full_match(t, '[A-Za-z]') AND length(b) < 30 THEN 'letter'
      WHEN regexp_full_match(t, '\\p{Nd}{1,3}') THEN 'number'
      WHEN regexp_full_match(t, '[\\x00-\\x7F]{1,2}') AND NOT regexp_full_match(t, '[0-9]+') AND length(b) < 30 THEN 'short'
      WHEN length(t) <= 5 AND length(t) - length(replace(t, '-', '')) = 1 AND regexp_full_match(replace(t, '-', ''), '[0-9]+') AND length(b) < 30 THEN 'page_range' END AS noise_reason
    FROM (SELECT id, trim(title) AS t, trim(body) AS b FROM src)"""


def _noise_input(spark, d):
    docs = table(spark, d, "documents").select((F.col("doc_id") + 1000).alias("id"), F.get(F.split("text", "\n"), 0).alias("title"), F.col("text").alias("body"))
    return docs.unionByName(spark.createDataFrame(NOISE_ROWS, "id long, title string, body string"))


NOISE_SRC = f"src AS (SELECT doc_id + 1000 AS id, string_split(text, chr(10))[1] AS title, text AS body FROM documents UNION ALL SELECT * FROM (VALUES {NOISE_VALUES}) v(id, title, body))"


@query(f"WITH {NOISE_SRC} {NOISE_SQL}")
def noise_verdict(spark, d):
    return quality.partition_noise(_noise_input(spark, d), "title", "body").select("id", "noise_reason")


@query(f"WITH {NOISE_SRC} SELECT coalesce(noise_reason, 'kept') AS reason, count(*) AS n FROM ({NOISE_SQL}) GROUP BY 1")
def noise_partition_counts(spark, d):
    rows = quality.partition_noise(_noise_input(spark, d), "title", "body")
    return rows.groupBy(F.coalesce("noise_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


PAGE_SQL = """SELECT page_id, generate_subscripts(m, 1) - 1 AS block_order, regexp_extract(unnest(m), '^<(h1|p|li)>', 1) AS tag, regexp_replace(unnest(m), '<[^>]*>', '', 'g') AS text
    FROM (SELECT page_id, regexp_extract_all(html, '(?s)<(?:h1|p|li)>.*?</(?:h1|p|li)>') AS m FROM pages)"""


@query(f"SELECT page_id, block_order, tag, md5(text) AS digest, last_value(CASE WHEN tag = 'h1' THEN text END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY block_order ROWS UNBOUNDED PRECEDING) AS chapter FROM ({PAGE_SQL})")
def page_blocks_carry_forward(spark, d):
    rows = segment.page_blocks(table(spark, d, "pages")).withColumn("level", F.when(F.col("tag") == "h1", 1))
    rows = segment.carry_forward(rows, "page_id", ["block_order"])
    return rows.select("page_id", "block_order", "tag", F.md5(F.col("text").cast("binary")).alias("digest"), "chapter")


@query(f"SELECT page_id, count(*) AS blocks, count(*) FILTER (tag = 'h1') AS headings, count(*) FILTER (tag = 'p') AS paragraphs, count(*) FILTER (tag = 'li') AS list_items, sum(length(text)) AS chars FROM ({PAGE_SQL}) GROUP BY 1")
def chapter_rollup(spark, d):
    n = lambda t: F.count_if(F.col("tag") == t)
    return segment.page_blocks(table(spark, d, "pages")).groupBy("page_id").agg(F.count(F.lit(1)).alias("blocks"), n("h1").alias("headings"), n("p").alias("paragraphs"), n("li").alias("list_items"), F.sum(F.length("text")).alias("chars"))


HEADS = [(1, 0, 0, "a", "heading", 1, "Chapter 1"), (1, 0, 1, "b", "paragraph", None, "x"), (1, 0, 2, "c", "heading", 2, "1.1 s"), (1, 0, 3, "d", "heading", 3, "deep"), (1, 0, 4, "e", "paragraph", None, "y"), (1, 1, 0, "f", "heading", 2, "1.2 s"), (1, 1, 1, "g", "heading", 1, "Chapter 2"), (1, 1, 2, "h", "paragraph", None, "z"), (2, 0, 0, "i", "paragraph", None, "lone"), (2, 0, 1, "j", "heading", 2, "first"), (2, 0, 2, "k", "heading", 1, "second")]
HEAD_VALUES = ", ".join("({})".format(", ".join("NULL" if v is None else repr(v) for v in r)) for r in HEADS)


@query(f"""
    WITH b AS (SELECT doc_id + 0 AS doc_id, page_index, block_order, block_id, type, level, row_number() OVER (PARTITION BY doc_id ORDER BY page_index, block_order) AS pos FROM (VALUES {HEAD_VALUES}) v(doc_id, page_index, block_order, block_id, type, level, text)
      UNION ALL SELECT page_id + 100, 0, block_order, 'b' || block_order, CASE WHEN tag = 'h1' THEN 'heading' ELSE 'paragraph' END, CASE WHEN tag = 'h1' THEN 1 END, row_number() OVER (PARTITION BY page_id ORDER BY block_order) FROM ({PAGE_SQL}))
    SELECT x.doc_id, x.block_id, max_by(h.block_id, h.pos) AS parent_id, false AS inferred FROM b x JOIN b h ON x.doc_id = h.doc_id AND h.pos < x.pos AND h.type = 'heading' AND (x.type <> 'heading' OR h.level < x.level) GROUP BY 1, 2""")
def heading_parent_asof(spark, d):
    page = segment.page_blocks(table(spark, d, "pages"))
    head = F.col("tag") == "h1"
    rows = page.select((F.col("page_id") + 100).alias("doc_id"), F.lit(0).alias("page_index"), "block_order", F.concat(F.lit("b"), F.col("block_order")).alias("block_id"), F.when(head, "heading").otherwise("paragraph").alias("type"), F.when(head, 1).alias("level"), "text")
    made = spark.createDataFrame(HEADS, "doc_id long, page_index int, block_order int, block_id string, type string, level int, text string")
    return structure.heading_parents(made.unionByName(rows))


# ---------------------------------------------------------------- topics

TOPICS = [
    taxonomy.Topic("animals-birds", ["the", "thand"], ["eri[nx]g"], ["zzz"], [], ["other"], 2),
    taxonomy.Topic("arithmetic", ["que", "eau", "eau"], ["é+"], [], ["vi.oi"], [], 1),
    taxonomy.Topic("botany", ["und"], ["sch[aeiou]", "ung[ .]"], ["licensed"], [], ["und der"], 0),
    taxonomy.Topic("chemistry", ["ción", "mente"], [], [], [], [], 0),
    taxonomy.Topic("drawing", ["of the", "ing"], ["\\d{4}"], [], [], ["ing of"], 0),
]


def _topic_sql() -> str:
    parts = []
    for i, t in enumerate(TOPICS):
        clean = "s"
        for w in t.stopwords:
            clean = f"replace({clean}, '{w}', '{' ' * len(w)}')"
        hits = [f"contains({clean}, '{k}')::INT" for k in t.keywords] + [f"regexp_matches(s, '{p}')::INT" for p in t.patterns]
        veto = " OR ".join([f"contains(s, '{k}')" for k in t.negative_keywords] + [f"regexp_matches(s, '{p}')" for p in t.negative_patterns]) or "false"
        parts.append(f"SELECT doc_id, '{t.topic_id}' AS topic_id, CASE WHEN {veto} THEN 0 ELSE {' + '.join(hits)} END AS score, {t.priority} AS priority, {i} AS topic_order FROM src")
    return "WITH src AS (SELECT doc_id, lower(text) AS s FROM documents), scores AS (SELECT * FROM ({}) WHERE score >= 1)".format(" UNION ALL ".join(parts))


def _items(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


TOP_SQL = _topic_sql() + ", best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, priority DESC, topic_order) AS rank FROM scores), assigned AS (SELECT src.doc_id, coalesce(topic_id, '_misc') AS topic_id, coalesce(rank, 1) AS rank, coalesce(score, 0) AS score FROM src LEFT JOIN (SELECT * FROM best WHERE rank <= 4) USING (doc_id))"


@query(_topic_sql() + " SELECT * FROM scores")
def topic_match_scores(spark, d):
    return taxonomy.match_scores(_items(spark, d), TOPICS, ["doc_id"])


@query(TOP_SQL + " SELECT * FROM assigned")
def topic_top4(spark, d):
    return taxonomy.top_topics(_items(spark, d), TOPICS, ["doc_id"])


@query(TOP_SQL + " SELECT topic_id, count(DISTINCT doc_id) AS items, sum(score)::BIGINT AS total_score FROM assigned GROUP BY 1")
def topic_usage_report(spark, d):
    return taxonomy.usage(taxonomy.top_topics(_items(spark, d), TOPICS, ["doc_id"]), ["doc_id"])


@query(TOP_SQL + " , t AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_topics, max(score) OVER (PARTITION BY doc_id) AS top FROM assigned), u AS (SELECT *, sum((score = top)::INT) OVER (PARTITION BY doc_id) AS ties FROM t) SELECT doc_id, topic_id, score, n_topics, n_topics >= 2 AND ties = 1 AS pruned FROM u WHERE NOT (n_topics >= 2 AND ties = 1) OR score = top")
def topic_pruning(spark, d):
    rows = taxonomy.top_topics(_items(spark, d), TOPICS, ["doc_id"])
    return planning.prune_topics(rows, ["doc_id"]).select("doc_id", "topic_id", "score", "n_topics", "pruned")


TREE_SQL = "WITH RECURSIVE n AS (SELECT 'world' AS id, NULL AS parent UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation), walk AS (SELECT id, [id] AS path FROM n WHERE parent IS NULL UNION ALL SELECT n.id, list_append(walk.path, n.id) FROM n JOIN walk ON n.parent = walk.id)"


def _tree(spark, d):
    root = spark.createDataFrame([("world", None)], "id string, parent string")
    region = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit("world").alias("parent"))
    nation = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    return taxonomy.tree_paths(root.unionByName(region).unionByName(nation))


@query(TREE_SQL + " SELECT id, array_to_string(path, '/') AS path, len(path) AS depth FROM walk")
def outline_leaf_paths(spark, d):
    return _tree(spark, d).select("id", F.array_join("path", "/").alias("path"), F.size("path").alias("depth"))


@query(TREE_SQL + ", l AS (SELECT * FROM walk WHERE id LIKE 'n%') SELECT a.id AS a, b.id AS b, CASE WHEN a.path[2] = b.path[2] THEN a.path[2] ELSE a.path[1] END AS ancestor FROM l a JOIN l b ON a.id < b.id")
def outline_lca(spark, d):
    leaf = _tree(spark, d).filter(F.col("id").startswith("n"))
    a, b = leaf.select(F.col("id").alias("a"), F.col("path").alias("pa")), leaf.select(F.col("id").alias("b"), F.col("path").alias("pb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", taxonomy.common_ancestor(F.col("pa"), F.col("pb")).alias("ancestor"))


# ---------------------------------------------------------------- media


@query("SELECT doc_id, sha256(text) AS sha256, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_id FROM documents")
def asset_dedup_sha256(spark, d):
    return media.dedup_by_digest(table(spark, d, "documents"), F.col("text").cast("binary"), "doc_id")


NAME_SQL = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1)"


TAIL_SQL = "regexp_extract(url, '([^/]*)$', 1)"


@query(f"SELECT {TAIL_SQL} AS name, min(page_id) AS page_id FROM pages GROUP BY 1 HAVING count(DISTINCT page_id) = 1 AND {TAIL_SQL.replace('url', 'min(url)')} <> ''")
def url_basename_unique(spark, d):
    return media.unambiguous_names(table(spark, d, "pages"), "url", "page_id")


@query("SELECT d.doc_id, d.n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def ref_backfill_anti(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def phrase_in_context(spark, d):
    phrases = table(spark, d, "benchmark").select("item_id", F.col("text").alias("phrase"))
    return media.holding(table(spark, d, "documents").select("doc_id", "text"), phrases, "text", "phrase").select("doc_id", "item_id")


@query("""
    WITH c AS (SELECT doc_id, contains(text, 'the') AS phrase, w * h < 10000 AS tiny, greatest(w, h) / least(w, h) > 5 AS aspect FROM (SELECT doc_id, text, n_chars AS w, len(string_split(text, chr(10))) AS h FROM documents))
    SELECT doc_id, CASE WHEN tiny THEN 'tiny' WHEN aspect THEN 'aspect' END AS decision,
      concat_ws(',', CASE WHEN phrase THEN 'phrase' END, CASE WHEN tiny THEN 'tiny' END, CASE WHEN NOT tiny AND aspect THEN 'aspect' END) AS fired,
      concat_ws(',', CASE WHEN NOT phrase THEN 'phrase' END, CASE WHEN NOT tiny THEN 'tiny' END, CASE WHEN NOT tiny AND NOT aspect THEN 'aspect' END) AS deferred FROM c""")
def prefilter_gated_rules(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", F.col("n_chars").alias("w"), F.size(F.split("text", "\n")).alias("h"))
    got = quality.first_approved(quality.image_rules(F.col("text"), F.col("w"), F.col("h"), ["the"]), ["tiny", "aspect"])
    return rows.select("doc_id", got["decision"].alias("decision"), F.array_join(got["fired"], ",").alias("fired"), F.array_join(got["deferred"], ",").alias("deferred"))


HAMMING_LIMIT = 18
BITS_SQL = "SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits FROM embeddings"
PAIR_SQL = f"p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_sum(list_transform(list_zip(a.bits, b.bits), lambda z: abs(z[1] - z[2])))::INT AS distance FROM ({BITS_SQL}) a JOIN ({BITS_SQL}) b ON a.vec_id < b.vec_id), q AS (SELECT * FROM p WHERE distance <= {HAMMING_LIMIT})"


def _hashes(spark, d):
    return table(spark, d, "embeddings").select("vec_id", media.sign_bits(F.col("embedding")).alias("bits"))


@query(f"WITH {PAIR_SQL} SELECT a, b, distance FROM q")
def hamming_pairs(spark, d):
    return media.hamming_pairs(_hashes(spark, d), "vec_id", "bits", HAMMING_LIMIT)


REACH_SQL = f"WITH RECURSIVE {PAIR_SQL}, e AS (SELECT a AS u, b AS v FROM q UNION ALL SELECT b, a FROM q), walk AS (SELECT vec_id AS n, vec_id AS m FROM embeddings UNION SELECT e.v, walk.m FROM walk JOIN e ON e.u = walk.n), label AS (SELECT n AS vec_id, min(m) AS cluster FROM walk GROUP BY 1)"


@query(REACH_SQL + " SELECT vec_id, cluster FROM label")
def hamming_components(spark, d):
    hashes = _hashes(spark, d)
    return media.clusters(hashes, "vec_id", media.near_forest(hashes, "vec_id", "bits", HAMMING_LIMIT))


@query(REACH_SQL + " SELECT cluster, count(*) AS members FROM label GROUP BY 1 HAVING count(*) >= 3")
def template_clusters(spark, d):
    hashes = _hashes(spark, d)
    found = media.clusters(hashes, "vec_id", media.near_forest(hashes, "vec_id", "bits", HAMMING_LIMIT))
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")).filter("members >= 3")


@query("""
    WITH u AS (SELECT doc_id % 100 AS figure_id, doc_id AS item_id FROM documents), r AS (SELECT doc_id % 100 AS figure_id, doc_id AS item_id, CASE WHEN toxic = 1 THEN 'decor' WHEN quality = 1 THEN 'content' ELSE 'ambiguous' END AS role, doc_id AS ord FROM labels),
    o AS (SELECT user_id * 3 AS figure_id, max_by(CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN 'decor' ELSE 'content' END, event_id) AS role FROM events GROUP BY 1), f AS (SELECT figure_id, max_by(role, ord) AS role FROM r GROUP BY 1)
    SELECT u.figure_id, u.item_id, coalesce(o.role, r.role, f.role, 'ambiguous') AS role FROM u LEFT JOIN o USING (figure_id) LEFT JOIN r ON r.figure_id = u.figure_id AND r.item_id = u.item_id LEFT JOIN f ON f.figure_id = u.figure_id""")
def role_effective(spark, d):
    uses = table(spark, d, "documents").select((F.col("doc_id") % 100).alias("figure_id"), F.col("doc_id").alias("item_id"))
    role = F.when(F.col("toxic") == 1, "decor").when(F.col("quality") == 1, "content").otherwise("ambiguous")
    records = table(spark, d, "labels").select((F.col("doc_id") % 100).alias("figure_id"), F.col("doc_id").alias("item_id"), role.alias("role"), F.col("doc_id").alias("ord"))
    ev = table(spark, d, "events")
    first = ev.agg(F.min("event_type").alias("t"))
    over = ev.crossJoin(F.broadcast(first)).select((F.col("user_id") * 3).alias("figure_id"), F.when(F.col("event_type") == F.col("t"), "decor").otherwise("content").alias("role"), F.col("event_id").alias("ord"))
    return media.effective_role(uses, records, over)


@query("WITH l AS (SELECT doc_id, sum(length(x)) AS bytes, max(length(x)) AS width, count(*) AS height FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) GROUP BY 1), c AS (SELECT doc_id % 50 AS cluster, * FROM l), g AS (SELECT cluster, count(*) AS members, max(bytes) / min(bytes) AS ratio, min(least(width, height) / greatest(width, height)) AS side FROM c GROUP BY 1) SELECT cluster, members, arg_max(doc_id, (bytes, width * height, -doc_id)) AS representative, bool_and(members >= 2 AND ratio < 5 AND side > 0.5) AS equal FROM c JOIN g USING (cluster) GROUP BY 1, 2".replace("SELECT cluster, members, arg_max", "SELECT cluster, members, arg_max"))
def cluster_representative(spark, d):
    x = F.split("text", "\n")
    rows = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.aggregate(x, F.lit(0), lambda s, v: s + F.length(v)).alias("bytes"), F.array_max(F.transform(x, lambda v: F.length(v))).alias("width"), F.size(x).alias("height"))
    rows = rows.select((F.col("doc_id") % 50).alias("cluster"), F.col("doc_id").alias("id"), "bytes", "width", "height")
    return media.visually_equal(rows)


# ---------------------------------------------------------------- review and control tables

ACTIONS_SQL = "CASE event_id % 3 WHEN 0 THEN 'confirm' WHEN 1 THEN 'correct' ELSE 'reject' END"


@query(f"SELECT user_id, event_type, max_by({ACTIONS_SQL}, struct_pack(t := ts, e := event_id)) AS action, max_by(event_id, struct_pack(t := ts, e := event_id)) AS event_id FROM events GROUP BY 1, 2")
def review_last_wins(spark, d):
    m = F.col("event_id") % 3
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", F.when(m == 0, "confirm").when(m == 1, "correct").otherwise("reject").alias("action"))
    return quality.latest(rows, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "action", "event_id")


EVIDENCE_SQL = "CASE user_id % 5 WHEN 0 THEN 'problem_text_and_diagram_mark' WHEN 1 THEN 'problem_text' WHEN 2 THEN 'diagram_mark' WHEN 3 THEN 'visual_inference' ELSE 'unknown' END"


def _reviewed(spark, d):
    ev, n, m = table(spark, d, "events"), F.col("user_id") % 5, F.col("event_id") % 3
    evidence = F.when(n == 0, "problem_text_and_diagram_mark").when(n == 1, "problem_text").when(n == 2, "diagram_mark").when(n == 3, "visual_inference").otherwise("unknown")
    rels = ev.filter(F.col("user_id") % 11 != 0).select(F.col("user_id").alias("figure_id"), F.lit("kind").alias("type"), F.array("event_type").alias("entities"), F.concat(F.lit("kind::"), "event_type").alias("key"), evidence.alias("evidence"), F.lit("unreviewed").alias("review_state")).distinct()
    dec = ev.select(F.col("user_id").alias("figure_id"), F.concat(F.lit("kind::"), "event_type").alias("key"), F.when(m == 0, "confirm").when(m == 1, "correct").otherwise("reject").alias("action"), F.col("event_id").alias("ord"))
    return rels, dec


def _valid(spark, d):
    """The decisions that may be applied: a review fails on the others."""
    rels, dec = _reviewed(spark, d)
    return rels, dec.join(facts.violations(rels, dec).select("ord"), "ord", "left_anti")


@query(f"SELECT event_id AS ord, CASE WHEN user_id % 11 = 0 THEN 'unknown_relation' ELSE 'not_promotable' END AS violation FROM events WHERE user_id % 11 = 0 OR (event_id % 3 = 0 AND {EVIDENCE_SQL} IN ('visual_inference', 'unknown'))")
def promotion_violations(spark, d):
    return facts.violations(*_reviewed(spark, d)).select("ord", "violation")


LAST_SQL = f"WITH e AS (SELECT *, {EVIDENCE_SQL} AS evidence, {ACTIONS_SQL} AS action FROM events WHERE user_id % 11 <> 0), s AS (SELECT user_id, event_type, evidence, max_by(action, event_id) FILTER (action <> 'confirm' OR evidence NOT IN ('visual_inference', 'unknown')) AS a FROM e GROUP BY ALL)"


@query(LAST_SQL + " SELECT CASE a WHEN 'confirm' THEN 'confirmed' WHEN 'correct' THEN 'corrected' WHEN 'reject' THEN 'rejected' ELSE 'unreviewed' END AS review_state, evidence, count(*) AS n FROM s GROUP BY 1, 2")
def review_state_counts(spark, d):
    return facts.apply_decisions(*_valid(spark, d)).groupBy("review_state", "evidence").agg(F.count(F.lit(1)).alias("n"))


@query(LAST_SQL + " SELECT DISTINCT user_id AS figure_id FROM s WHERE evidence IN ('visual_inference', 'unknown') AND coalesce(a, 'reject') = 'reject'")
def blocked_figures(spark, d):
    return facts.blocked_figures(facts.apply_decisions(*_valid(spark, d)))


@query("SELECT user_id % 20 AS doc_id, event_type AS stage, min(ts) AS first_started_at, max(ts) AS last_updated_at, max_by(CASE WHEN event_id % 4 = 0 THEN 'completed' WHEN event_id % 4 = 1 THEN 'failed' ELSE 'running' END, event_id) AS status, max_by('f' || (event_id % 10), event_id) FILTER (event_id % 5 <> 0) AS input_fingerprint FROM events GROUP BY 1, 2")
def stage_latest(spark, d):
    m = F.col("event_id") % 4
    rows = table(spark, d, "events").select((F.col("user_id") % 20).alias("doc_id"), F.col("event_type").alias("stage"), F.col("ts").alias("at"), F.col("event_id").alias("ord"), F.when(m == 0, "completed").when(m == 1, "failed").otherwise("running").alias("status"), F.lit(None).cast("string").alias("error"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("f"), F.col("event_id") % 10)).alias("input_fingerprint"), F.lit(None).cast("string").alias("output_fingerprint"))
    return stages.fold_records(rows).select("doc_id", "stage", "first_started_at", "last_updated_at", "status", "input_fingerprint")


@query("SELECT ts::DATE AS day, sum(event_id % 7)::BIGINT AS pages FROM events GROUP BY 1")
def daily_quota(spark, d):
    return quality.pages_used(table(spark, d, "events").select("ts", (F.col("event_id") % 7).alias("pages")))


@query("""WITH s AS (SELECT event_id, user_id % 2 = 0 AS today, event_id % 1100 AS used, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 400 - 20 END AS est FROM events), n AS (SELECT *, CASE WHEN today THEN used ELSE 0 END AS now FROM s)
    SELECT event_id, CASE WHEN est IS NULL AND now >= 1000 THEN 'REFUSE_PRE' WHEN est IS NULL THEN 'WARN_LIVE' WHEN est > 0 AND now + est > 1000 THEN 'REFUSE_PRE' ELSE 'ALLOW' END AS decision FROM n""")
def quota_decisions(spark, d):
    day = lambda x: F.lit(x).cast("date")
    k = F.col("event_id")
    said = quality.quota_decision(F.when(F.col("user_id") % 2 == 0, day("2024-02-02")).otherwise(day("2024-02-01")), day("2024-02-02"), k % 1100, F.lit(1000), F.when(k % 5 != 0, k % 400 - 20))
    return table(spark, d, "events").select("event_id", said.alias("decision"))


@query("""
    SELECT doc_id, length(trim(text)) AS chars, len(l) AS lines, len(s) AS short_lines,
      CASE WHEN length(trim(text)) < 50 THEN 'error' WHEN len(l) > 10 AND len(s) > len(l) * 0.6 THEN 'warning' ELSE 'ok' END AS severity,
      concat_ws(',', CASE WHEN length(trim(text)) < 50 THEN 'error:too_short' END, CASE WHEN len(list_filter(l, lambda x: regexp_matches(x, '^#{1,6} '))) = 0 THEN 'info:no_heading' END, CASE WHEN len(l) > 10 AND len(s) > len(l) * 0.6 THEN 'warning:fragmented' END) AS messages
    FROM (SELECT *, list_filter(l, lambda x: length(x) <= 2) AS s FROM (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM documents))""")
def preflight_health(spark, d):
    return quality.health(table(spark, d, "documents"))


@query("SELECT a.page_id, array_to_string(list_sort(list_filter(a.l, lambda x: NOT list_contains(b.l, x))), ' ') AS only_here FROM (SELECT page_id, list_distinct(regexp_extract_all(html, '(?:href|src)=\"([^\"]*)\"', 1)) AS l FROM pages) a JOIN (SELECT page_id - 1 AS page_id, list_distinct(regexp_extract_all(html, '(?:href|src)=\"([^\"]*)\"', 1)) AS l FROM pages) b USING (page_id)")
def md_layout_diff(spark, d):
    from leafmill.sources.layout import links

    a = table(spark, d, "pages").select("page_id", links(F.col("html")).alias("a"))
    b = a.select((F.col("page_id") - 1).alias("page_id"), F.col("a").alias("b"))
    return a.join(b, "page_id").select("page_id", F.array_join(F.array_sort(F.array_except("a", "b")), " ").alias("only_here"))


# ---------------------------------------------------------------- planning


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def export_scope_semi(spark, d):
    big = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(big, "o_orderkey", "left_semi")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 30 WHEN 'assistant' THEN 50 ELSE 70 END, turn) AS pos FROM conversations")
def mode_b_order(spark, d):
    rank = planning.type_priority(F.col("role"), {"system": 0, "user": 30, "assistant": 50})
    w = W.partitionBy("conv_id").orderBy(rank, "turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.row_number().over(w).alias("pos"))


@query("SELECT conv_id, turn, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role, role FROM conversations")
def bridge_pairs(spark, d):
    return planning.adjacent(table(spark, d, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "prev_role", "role")


@query("WITH r AS (SELECT DISTINCT l_orderkey AS plan_id, l_partkey AS item_id FROM lineitem), s AS (SELECT plan_id, count(*) AS n, min(item_id) AS only FROM r GROUP BY 1), m AS (SELECT a.plan_id, min(struct_pack(n := b.n, p := b.plan_id)) AS b FROM s a JOIN r ON r.item_id = a.only JOIN s b ON b.plan_id = r.plan_id AND b.n > 1 WHERE a.n = 1 GROUP BY 1) SELECT plan_id, b.p AS by_plan, b.n AS by_size FROM m")
def plan_subset_dedup(spark, d):
    return planning.superseded(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("plan_id"), F.col("l_partkey").alias("item_id")))


@query("SELECT CASE WHEN topic = 'zz' THEN '_misc' ELSE topic END AS topic_id, dense_rank() OVER (ORDER BY topic) AS plan_seq, row_number() OVER (PARTITION BY topic ORDER BY CASE role WHEN 'system' THEN 70 ELSE 70 END, conv_id, turn) AS pos, conv_id || '-' || turn AS item_id FROM (SELECT *, CASE WHEN conv_id % 5 = 0 THEN 'zz' ELSE 't' || (conv_id % 5) END AS topic FROM conversations)")
def plan_sequence(spark, d):
    c = table(spark, d, "conversations")
    topic = F.when(F.col("conv_id") % 5 == 0, "_misc").otherwise(F.concat(F.lit("t"), F.col("conv_id") % 5))
    return planning.plan_items(c.select(topic.alias("topic_id"), F.concat_ws("-", "conv_id", "turn").alias("item_id"), F.col("role").alias("item_type"), F.col("turn").alias("item_seq")))


@query("WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN left(text, 30) || ' and' WHEN turn % 7 = 1 THEN '- ' || text ELSE text END AS text FROM conversations) SELECT a.conv_id, a.turn FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE length(trim(a.text, ' ')) >= 10 AND NOT regexp_matches(trim(a.text, ' '), '[。！？!?.;；:：]$') AND NOT regexp_matches(b.text, '^\\s*([-*+•]|[0-9]+[.)、])')")
def adjacent_continuation(spark, d):
    cut = F.when(F.col("turn") % 3 == 0, F.concat(F.substring("text", 1, 30), F.lit(" and"))).when(F.col("turn") % 7 == 1, F.concat(F.lit("- "), "text")).otherwise(F.col("text"))
    c = table(spark, d, "conversations").withColumn("text", cut)
    blocks = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_index"), F.lit(0).alias("block_order"), F.col("turn").alias("block_id"), F.lit("text").alias("type"), "text", F.lit(None).cast("array<double>").alias("bbox"))
    return structure.continuations(blocks).select(F.col("doc_id").alias("conv_id"), F.col("source_id").alias("turn"))


@query(f"""
    WITH l AS ({LINES_SQL}), a AS (SELECT doc_id, line_no AS anchor_line, 'a' || line_no AS anchor_id FROM l WHERE contains(line, '|')),
    m AS (SELECT l.doc_id, l.line_no, min(struct_pack(dist := abs(anchor_line - line_no), behind := (anchor_line < line_no)::INT, anchor_line := anchor_line, anchor_id := anchor_id)) AS x FROM l JOIN a USING (doc_id) WHERE line <> '' GROUP BY 1, 2)
    SELECT doc_id, line_no, x.anchor_id AS anchor_id, x.dist AS dist, CASE WHEN x.dist <= 2 THEN 0.9 ELSE 0.65 END::DOUBLE AS confidence FROM m""")
def nearest_anchor(spark, d):
    rows = segment.lines(table(spark, d, "documents"))
    anchors = rows.filter(F.contains("line", F.lit("|"))).select("doc_id", F.col("line_no").alias("anchor_line"), F.concat(F.lit("a"), "line_no").alias("anchor_id"))
    return structure.nearest_anchor(rows.filter("line <> ''").select("doc_id", "line_no"), anchors)


BOXES = [(1, 0, k, f"b{k}", t, [x, y, x + 50.0, y + 10.0 + h], s) for k, (t, x, y, h, s) in enumerate([("paragraph", 0.0, 0.0, 0.0, "text one that is long"), ("figure", 0.0, 20.0, 40.0, ""), ("caption", 0.0, 70.0, 0.0, "图 1"), ("paragraph", 0.0, 90.0, 0.0, "text two"), ("figure", 100.0, 110.0, 40.0, ""), ("figure", 300.0, 110.0, 40.0, ""), ("caption", 200.0, 130.0, 0.0, "figure 2")])]
BOX_VALUES = ", ".join(f"({r[0]}, {r[1]}, {r[2]}, '{r[3]}', '{r[4]}', {r[5]}, '{r[6]}')" for r in BOXES)
BOX_SQL = f"WITH b AS (SELECT * FROM (VALUES {BOX_VALUES}) v(doc_id, page_index, block_order, block_id, type, bbox, text)), d AS (SELECT c.block_id AS source_id, v.block_id AS target_id, abs((c.bbox[2] + c.bbox[4]) / 2 - (v.bbox[2] + v.bbox[4]) / 2) + 0.25 * abs((c.bbox[1] + c.bbox[3]) / 2 - (v.bbox[1] + v.bbox[3]) / 2) AS d FROM b c JOIN b v ON v.type = 'figure' WHERE c.type = 'caption')"


@query(BOX_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY d, target_id) AS i, lead(d) OVER (PARTITION BY source_id ORDER BY d, target_id) AS nxt FROM d) SELECT source_id, target_id, 'caption_for' AS kind FROM r WHERE i = 1 AND (nxt IS NULL OR nxt - d >= 0.001)")
def nearest_unique(spark, d):
    rows = spark.createDataFrame(BOXES, "doc_id long, page_index int, block_order int, block_id string, type string, bbox array<double>, text string")
    return structure.captions(rows).select("source_id", "target_id", "kind")


FIGS = [(1, "AB ∥ CD，交于点 E", ""), (2, "M 是 AB 的中点", "图"), (3, "AB 垂直 CD 且 AB = CD", ""), (4, "nothing here", ""), (5, "Segment AB and CD: AB // CD", "cap"), (6, "说明三角形 ABC", "AB ∥ CD"), (7, "in the text \\triangle{P Q R} with ∠ and 角 Q 相等", ""), (8, "点 A 点 B 共线", ""), (9, "\\overline{XY} \\perp ZW", "XY ⊥ ZW"), (10, "AA 等长 BB and EF", ""), (11, "三点 C D 在同一直线", None), (12, None, "GH 等长 KL"), (13, "midpoint", "")]


def _figures_sql() -> str:
    quote = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quote(t)}, {quote(c)})" for i, t, c in FIGS)
    rules = ", ".join(f"({k}, '{t}', '{p}')" for k, (t, p) in enumerate(facts.RULES.items()))
    return f"""WITH src AS (SELECT id, coalesce(t, '') AS body, coalesce(c, '') AS said FROM (VALUES {rows}) v(id, t, c)), rules AS (SELECT * FROM (VALUES {rules}) r(k, type, pattern)),
    both_ AS (SELECT id, 0 AS which, body AS x FROM src UNION ALL SELECT id, 1, said FROM src),
    letter AS (SELECT id, which, unnest(regexp_extract_all(regexp_replace(x, '\\\\[a-z][A-Za-z]*', ' ', 'g'), '[A-Z]')) AS p, generate_subscripts(regexp_extract_all(regexp_replace(x, '\\\\[a-z][A-Za-z]*', ' ', 'g'), '[A-Z]'), 1) AS i FROM both_),
    firsts AS (SELECT id, which, p, min(i) AS i FROM letter GROUP BY ALL), chosen AS (SELECT id, min(which) AS which FROM firsts GROUP BY 1),
    pts AS (SELECT f.id, f.p, row_number() OVER (PARTITION BY f.id ORDER BY f.i) AS i FROM firsts f JOIN chosen USING (id, which)),
    word AS (SELECT id, which, unnest(regexp_extract_all(x, '[\\p{{L}}\\p{{N}}_]+')) AS w, generate_subscripts(regexp_extract_all(x, '[\\p{{L}}\\p{{N}}_]+'), 1) AS i FROM both_),
    pair AS (SELECT id, which, w, min(i) AS i FROM word WHERE regexp_full_match(w, '[A-Z][A-Z]') AND w[1] <> w[2] AND EXISTS (SELECT 1 FROM pts WHERE pts.id = word.id AND pts.p = w[1]) AND EXISTS (SELECT 1 FROM pts WHERE pts.id = word.id AND pts.p = w[2]) GROUP BY ALL),
    side AS (SELECT id, min(which) AS which FROM pair GROUP BY 1), segs AS (SELECT pair.id, w AS s, pair.i FROM pair JOIN side USING (id, which)),
    fired AS (SELECT id, k, type, pattern, said, regexp_matches(body, pattern) AS in_text FROM src, rules WHERE regexp_matches(body, pattern) OR regexp_matches(said, pattern)),
    ents AS (SELECT f.id, f.type, s AS e FROM fired f JOIN segs USING (id) WHERE type IN ('equal_length', 'parallel', 'perpendicular', 'midpoint', 'point_on_segment', 'collinear')
      UNION ALL SELECT f.id, f.type, s || '+' || p FROM fired f JOIN segs USING (id) JOIN pts USING (id) WHERE type IN ('midpoint', 'point_on_segment', 'collinear') AND NOT contains(s, p)
      UNION ALL SELECT f.id, f.type, a.p || '+' || b.p FROM fired f JOIN pts a USING (id) JOIN pts b USING (id) WHERE type IN ('midpoint', 'point_on_segment', 'collinear') AND a.i < b.i AND NOT EXISTS (SELECT 1 FROM segs WHERE segs.id = f.id)
      UNION ALL SELECT f.id, f.type, a.p || '+' || b.p || '+' || c.p FROM fired f JOIN pts a USING (id) JOIN pts b USING (id) JOIN pts c USING (id) WHERE type = 'equal_angle' AND a.i < b.i AND c.i >= a.i + 2)"""


def _figures(spark):
    return spark.createDataFrame(FIGS, "figure_id int, text string, caption string")


@query(_figures_sql() + " SELECT ents.id AS figure_id, ents.type, e AS entities, ev AS evidence, CASE ev WHEN 'problem_text' THEN 0.9 WHEN 'diagram_mark' THEN 0.7 ELSE 0.95 END::DOUBLE AS confidence FROM ents JOIN (SELECT id, type, CASE WHEN said <> '' AND in_text THEN 'problem_text_and_diagram_mark' WHEN said <> '' THEN 'diagram_mark' ELSE 'problem_text' END AS ev FROM fired) g ON g.id = ents.id AND g.type = ents.type")
def relation_extract(spark, d):
    return facts.relations(_figures(spark)).select("figure_id", "type", F.array_join("entities", "+").alias("entities"), "evidence", "confidence")


@query(_figures_sql() + " SELECT id AS figure_id, type || ': ' || pattern AS observation FROM fired f WHERE NOT EXISTS (SELECT 1 FROM ents WHERE ents.id = f.id AND ents.type = f.type)")
def relation_observations(spark, d):
    return facts.observations(_figures(spark))


@query(_figures_sql() + ", locs AS (SELECT * FROM (VALUES ('zh'), ('en')) l(locale)) SELECT id AS figure_id, type, locale, e AS entities, CASE type WHEN 'parallel' THEN CASE locale WHEN 'zh' THEN x[1] || ' 平行于 ' || coalesce(x[2], '') || '。' ELSE x[1] || ' is parallel to ' || coalesce(x[2], '') || '.' END WHEN 'perpendicular' THEN CASE locale WHEN 'zh' THEN x[1] || ' 垂直于 ' || coalesce(x[2], '') || '。' ELSE x[1] || ' is perpendicular to ' || coalesce(x[2], '') || '.' END WHEN 'equal_length' THEN CASE locale WHEN 'zh' THEN x[1] || ' 与 ' || coalesce(x[2], '') || ' 等长。' ELSE x[1] || ' and ' || coalesce(x[2], '') || ' have equal length.' END WHEN 'equal_angle' THEN CASE locale WHEN 'zh' THEN '∠' || array_to_string(x, '') || ' = ∠。' ELSE '∠' || array_to_string(x, '') || ' and ∠ are equal.' END WHEN 'midpoint' THEN CASE locale WHEN 'zh' THEN x[1] || ' 是 ' || coalesce(x[2], '') || ' 的中点。' ELSE x[1] || ' is the midpoint of ' || coalesce(x[2], '') || '.' END WHEN 'collinear' THEN CASE locale WHEN 'zh' THEN x[1] || '、' || coalesce(x[2], '') || '、 三点共线。' ELSE x[1] || ', ' || coalesce(x[2], '') || ', and  are collinear.' END END AS sentence FROM (SELECT *, string_split(e, '+') AS x FROM ents), locs")
def relation_sentences(spark, d):
    rows = facts.relations(_figures(spark)).withColumn("locale", F.explode(F.array(F.lit("zh"), F.lit("en"))))
    return facts.sentences(rows, F.col("locale")).select("figure_id", "type", "locale", F.array_join("entities", "+").alias("entities"), "sentence")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    from leafmill.streaming.intake import windowed_counts

    return windowed_counts(table(spark, d, "events"))


# ---------------------------------------------------------------- results without SQL


def _book_items(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("item_seq"), F.concat(F.lit("item-"), "turn").alias("item_id"), F.when(F.col("role") == "system", "definition").otherwise("example").alias("item_type"), F.col("role").alias("title"), "text", T.tokens(F.lower("text")).alias("tokens"))
    return c.withColumns({"chapter": F.lit(""), "chapter_path": F.array(F.lit("chat"), F.col("title"))})


@query()
def bookview_nested(spark, d):
    from leafmill.operators.binding import nested_book

    return nested_book(_book_items(spark, d)).select("doc_id", F.to_json("chapters").alias("chapters"))


@query()
def greedy_binding(spark, d):
    from leafmill.operators.binding import greedy_binding as bind

    items = _book_items(spark, d)
    blocks = _book_items(spark, d).select("doc_id", F.lit("").alias("chapter"), F.col("item_seq").alias("page_index"), F.lit(0).alias("block_order"), F.concat(F.lit("b"), "item_seq").alias("block_id"), F.when(F.col("item_seq") % 3 == 2, "figure").otherwise("text").alias("type"), "text", "tokens", (F.col("item_seq") % 3 == 2).alias("has_image"), F.lit(None).cast("string").alias("attached_to"))
    return bind(items, blocks)


@query()
def render_model(spark, d):
    from leafmill.operators import render

    items = _book_items(spark, d).select(F.col("doc_id").alias("plan_id"), F.col("item_seq").alias("pos"), F.concat_ws("-", "doc_id", "item_id").alias("item_id"), "title", "text")
    figures = items.filter("pos % 2 = 0").select("item_id", F.concat(F.lit("f"), "pos").alias("figure_id"), (F.col("pos") % 4 == 0).alias("present"))
    roles = figures.select("figure_id", "item_id", F.lit("content").alias("role"))
    lines = render.render_model(items, figures, roles, spark.createDataFrame([("f4",)], "figure_id string"))
    return render.validation(lines)


@query()
def extracted_items(spark, d):
    return segment.extract_items(table(spark, d, "documents")).select("doc_id", "item_seq", "item_id", "item_type", "title", F.array_join("chapter_path", "/").alias("chapter_path"))
