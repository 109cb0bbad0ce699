"""Relations read from geometry texts, their sentences, and review decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import text as T
from leafmill.operators.quality import latest

# Relation patterns, sentences, evidence and states.
RULES = {
    "parallel": r"∥|平行|//|\\parallel",
    "perpendicular": r"⊥|垂直|\\perp",
    "equal_length": r"=\s*[A-Z]{1,3}.*[A-Z]{1,3}|等长|相等.*边",
    "equal_angle": r"∠|角.*相等|等角",
    "midpoint": r"中点|midpoint",
    "collinear": r"共线|三点.*在.*同.*(直)?线",
    "point_on_segment": r"D\s*在\s*[A-Z]{1,3}上|点.*在.*线段.*上|on segment",
}
CONFIDENCE = {"problem_text_and_diagram_mark": 0.95, "problem_text": 0.90, "diagram_mark": 0.70, "visual_inference": 0.40, "unknown": 0.10}
PROMOTABLE = ("problem_text", "problem_text_and_diagram_mark", "diagram_mark")
EXPORTABLE = ("confirmed", "corrected")
SENTENCES = {
    "parallel": ("{a} 平行于 {b}。", "{a} is parallel to {b}."),
    "perpendicular": ("{a} 垂直于 {b}。", "{a} is perpendicular to {b}."),
    "equal_length": ("{a} 与 {b} 等长。", "{a} and {b} have equal length."),
    "equal_angle": ("∠{angle} = ∠{angle2}。", "∠{angle} and ∠{angle2} are equal."),
    "midpoint": ("{a} 是 {b} 的中点。", "{a} is the midpoint of {b}."),
    "collinear": ("{a}、{b}、{c} 三点共线。", "{a}, {b}, and {c} are collinear."),
    "point_on_segment": ("{a} 在线段 {b} 上。", "{a} lies on segment {b}."),
}
BRIDGE_ORDER = ("equal_length", "parallel", "perpendicular", "midpoint", "collinear", "point_on_segment", "equal_angle")
PER_SEGMENT = ("equal_length", "parallel", "perpendicular")
WITH_POINTS = ("midpoint", "point_on_segment", "collinear")
TRIANGLE = r"\\triangle\s*\{\s*([A-Z]\s*[A-Z]\s*[A-Z])\s*\}"
ANGLE = r"\\(?:angle|measuredangle)\s*\{\s*([A-Z]\s*[A-Z]\s*[A-Z])\s*\}"
OVERLINE = r"\\(?:overline|overrightarrow)\s*\{\s*([A-Z])\s*([A-Z])\s*\}"
_NAMES = "array<array<string>>"


def points(text: Column) -> Column:
    """Distinct capital letters in order: those of triangles and of angles first, then all but those inside a LaTeX command."""
    inside = lambda pattern: F.flatten(F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda s: F.regexp_extract_all(s, F.lit("[A-Z]"), 0)))
    bare = F.regexp_replace(F.regexp_replace(text, r"\\\\([A-Za-z])[A-Za-z]*", "$1 "), r"\\[a-z][A-Za-z]*", " ")
    return F.array_distinct(F.concat(inside(TRIANGLE), inside(ANGLE), F.regexp_extract_all(bare, F.lit("[A-Z]"), 0)))


def segments(text: Column, known: Column) -> Column:
    """Distinct words of two different known points, in order, and the two points of an overline or arrow."""
    pair = F.array_distinct(F.regexp_extract_all(F.regexp_replace(text, OVERLINE, " $1$2 "), F.lit(r"(?U)\b([A-Z]{2})\b"), 1))
    return F.filter(pair, lambda s: F.array_contains(known, F.substring(s, 1, 1)) & F.array_contains(known, F.substring(s, 2, 1)) & (F.substring(s, 1, 1) != F.substring(s, 2, 1)))


def index_pairs(xs: Column) -> Column:
    """All pairs (x_i, x_j) with i < j of a short list."""
    n = F.size(xs)
    grid = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda j: j > i), lambda j: F.array(F.get(xs, i), F.get(xs, j))))
    return F.when(n >= 2, F.flatten(grid)).otherwise(F.array().cast("array<array<string>>"))


def angle_triples(xs: Column) -> Column:
    """[x_i, x_j, x_k] for i < j and k >= i + 2, duplicates included."""
    n = F.size(xs)
    at = lambda i: F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda j: j > i), lambda j: F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda k: k >= i + 2), lambda k: F.array(F.get(xs, i), F.get(xs, j), F.get(xs, k))))
    grid = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.flatten(at(i)))
    return F.when(n >= 3, F.flatten(grid)).otherwise(F.array().cast("array<array<string>>"))


def segment_combinations(segs: Column, pts: Column) -> Column:
    """For each segment the segment alone, then with each point outside it; without segments all pairs of points."""
    one = lambda s: F.concat(F.array(F.array(s)), F.transform(F.filter(pts, lambda p: ~F.contains(s, p)), lambda p: F.array(s, p)))
    return F.when(F.size(segs) > 0, F.flatten(F.transform(segs, one))).otherwise(index_pairs(pts))


def _marked(figures: DataFrame, rules: dict[str, str]) -> DataFrame:
    """figures with points, segments and the rules that fire in text or caption."""
    body, said = F.coalesce("text", F.lit("")), F.coalesce("caption", F.lit(""))
    either = lambda own, other: F.when(F.size(own) > 0, own).otherwise(other)
    rows = figures.withColumn("points", either(points(body), points(said)))
    rows = rows.withColumn("segments", either(segments(body, F.col("points")), segments(said, F.col("points"))))
    fired = [F.when(body.rlike(f"(?U){p}") | said.rlike(f"(?U){p}"), F.struct(F.lit(k).alias("k"), F.lit(t).alias("type"), F.lit(p).alias("pattern"), body.rlike(f"(?U){p}").alias("in_text"))) for k, (t, p) in enumerate(rules.items())]
    return rows.withColumn("rule", F.explode(F.array_compact(F.array(*fired))))


def _entities(kind: Column) -> Column:
    segs, pts = F.col("segments"), F.col("points")
    return F.when(kind.isin(*PER_SEGMENT), F.transform(segs, lambda s: F.array(s))).when(kind.isin(*WITH_POINTS), segment_combinations(segs, pts)).when(kind == "equal_angle", angle_triples(pts)).otherwise(F.array().cast(_NAMES))


def relations(figures: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """figure_id, ord, type, entities, evidence, confidence, key, review_state of figures (figure_id, text, caption with labels).

    A caption that is not empty makes the evidence a diagram mark, with the text where the rule fires there too.
    """
    rows = _marked(figures, rules).select("figure_id", F.coalesce("caption", F.lit("")).alias("caption"), "rule", F.posexplode(_entities(F.col("rule.type"))).alias("i", "entities"))
    marked = F.col("caption") != ""
    evidence = F.when(F.col("rule.in_text") & marked, "problem_text_and_diagram_mark").when(marked, "diagram_mark").when(F.col("rule.in_text"), "problem_text").otherwise("visual_inference")
    conf = F.lit(CONFIDENCE["unknown"])
    for k, v in CONFIDENCE.items():
        conf = F.when(F.col("evidence") == k, v).otherwise(conf)
    rows = rows.select("figure_id", F.struct(F.col("rule.k").alias("rule"), F.col("i")).alias("ord"), F.col("rule.type").alias("type"), "entities", evidence.alias("evidence"))
    return rows.select("figure_id", "ord", "type", "entities", "evidence", conf.alias("confidence"), T.relation_key(F.col("type"), F.col("entities")).alias("key"), F.lit("unreviewed").alias("review_state"))


def observations(figures: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """figure_id, observation: rules that fire and find no entities."""
    rows = _marked(figures, rules).filter(F.size(_entities(F.col("rule.type"))) == 0)
    return rows.select("figure_id", F.concat_ws(": ", "rule.type", "rule.pattern").alias("observation"))


def figure_items(items: DataFrame) -> DataFrame:
    """item_id, asset_id of items (item_id, ord, asset_refs) with an asset: the first row of an item, and its first asset, count."""
    first = items.groupBy("item_id").agg(F.min_by("asset_refs", "ord").alias("refs"))
    return first.select("item_id", F.get("refs", 0).alias("asset_id")).filter(F.coalesce("asset_id", F.lit("")) != "")


def sentences(rels: DataFrame, locale: Column) -> DataFrame:
    """rels with the sentence of each relation in its locale; names that are wanting are empty."""
    out = F.lit(None).cast("string")
    for kind, (zh, en) in SENTENCES.items():
        out = F.when(F.col("type") == kind, F.when(locale == "zh", zh).otherwise(en)).otherwise(out)
    name = lambda k: F.coalesce(F.get("entities", k), F.lit(""))
    for mark, said in (("{a}", name(0)), ("{b}", name(1)), ("{c}", name(2)), ("{angle}", F.array_join(F.slice("entities", 1, 3), "")), ("{angle2}", F.when(F.size("entities") >= 6, F.array_join(F.slice("entities", 4, 3), "")).otherwise(""))):
        out = F.replace(out, F.lit(mark), said)
    return rels.withColumn("sentence", out)


def best_reviewed(plan_assets: DataFrame, rels: DataFrame) -> DataFrame:
    """plan_id, text: the exportable relation of a plan's figures that comes first by type, then key, then text."""
    rank = F.lit(len(BRIDGE_ORDER))
    for k, kind in enumerate(BRIDGE_ORDER):
        rank = F.when(F.col("type") == kind, k).otherwise(rank)
    ready = rels.filter(F.col("review_state").isin(*EXPORTABLE))
    said = F.concat("type", F.lit("("), F.array_join("entities", "、"), F.lit(")"))
    met = plan_assets.select("plan_id", "figure_id").distinct().join(ready, "figure_id").select("plan_id", F.struct(rank.alias("rank"), "key", said.alias("text")).alias("r"))
    return met.groupBy("plan_id").agg(F.min("r").alias("r")).select("plan_id", "r.text")


def merge_candidates(rules: DataFrame, model: DataFrame) -> DataFrame:
    """model rows with verdict agree (same key), conflict (same entities, other type) or new."""
    same = rules.select("figure_id", "key", F.lit(True).alias("agrees")).distinct()
    kin = rules.select("figure_id", F.array_sort(F.array_distinct("entities")).alias("names"), F.lit(True).alias("meets")).distinct()
    out = model.withColumn("names", F.array_sort(F.array_distinct("entities"))).join(same, ["figure_id", "key"], "left").join(kin, ["figure_id", "names"], "left")
    verdict = F.when(F.col("agrees"), "agree").when(F.col("meets"), "conflict").otherwise("new")
    return out.withColumn("verdict", verdict).drop("agrees", "meets", "names")


def apply_decisions(rels: DataFrame, decisions: DataFrame) -> DataFrame:
    """rels with review_state, entities, key and review_note after the decisions on (figure_id, key), in their order `ord`.

    rels: figure_id, type, entities, evidence, review_state. decisions: figure_id, key, action, ord and, where given,
    corrected_entities and note. Corrected entities change the key that later decisions must name, so the decisions of one
    figure are applied in turn. A decision on an unknown relation, or a confirmation of weak evidence, fails the query.
    """
    import pandas as pd

    states = {"confirm": "confirmed", "correct": "corrected", "reject": "rejected"}
    for name, kind in (("corrected_entities", "array<string>"), ("note", "string")):
        if name not in decisions.columns:
            decisions = decisions.withColumn(name, F.lit(None).cast(kind))
    key = lambda kind, names: f"{kind}::" + "+".join(sorted(n.lower() for n in names))

    def apply(_: tuple, have: pd.DataFrame, said: pd.DataFrame) -> pd.DataFrame:
        rows = [dict(r, entities=list(r["entities"]), review_note=None) for r in have.to_dict("records")]
        for d in said.sort_values("ord").to_dict("records"):
            met = next((r for r in rows if key(r["type"], r["entities"]) == d["key"]), None)
            if met is None:
                raise ValueError(f"unknown relation {d['key']!r} of figure {d['figure_id']!r}")
            if d["action"] == "confirm" and met["evidence"] not in PROMOTABLE:
                raise ValueError(f"cannot confirm evidence {met['evidence']!r} of figure {d['figure_id']!r}")
            met["review_state"] = states[d["action"]]
            if d["corrected_entities"] is not None and len(d["corrected_entities"]):
                met["entities"] = list(d["corrected_entities"])
            if d["note"]:
                met["review_note"] = d["note"]
        return pd.DataFrame([(*[r[c] for c in names[:-2]], r["review_note"], key(r["type"], r["entities"])) for r in rows], columns=names)

    names = ["figure_id", "type", "entities", "evidence", "review_state", "review_note", "key"]
    kind = rels.schema["figure_id"].dataType.simpleString()
    own = rels.select(*names[:-2]).groupBy("figure_id")
    made = own.cogroup(decisions.select("figure_id", "key", "action", "ord", "corrected_entities", "note").groupBy("figure_id"))
    return made.applyInPandas(apply, f"figure_id {kind}, type string, entities array<string>, evidence string, review_state string, review_note string, key string")


def audit(existing: DataFrame, applied: DataFrame) -> DataFrame:
    """The decision log: the last decision of each (figure_id, key), new ones after those of the log, in that order."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(applied.withColumn("_new", F.lit(1)))
    return latest(both, ["figure_id", "key"], [F.col("_new"), F.col("ord")]).drop("_new").orderBy("figure_id", "key")


def violations(rels: DataFrame, decisions: DataFrame) -> DataFrame:
    """Confirm decisions on evidence that may not be promoted, and decisions on unknown relations."""
    met = decisions.join(rels.select("figure_id", "key", "evidence"), ["figure_id", "key"], "left")
    bad = F.when(F.col("evidence").isNull(), "unknown_relation").when((F.col("action") == "confirm") & ~F.col("evidence").isin(*PROMOTABLE), "not_promotable")
    return met.withColumn("violation", bad).filter(F.col("violation").isNotNull())


def blocked_figures(rels: DataFrame) -> DataFrame:
    """Figures with a relation that is not exportable and rests on weak evidence."""
    weak = F.col("evidence").isin("visual_inference", "unknown") & ~F.col("review_state").isin(*EXPORTABLE)
    return rels.filter(weak).select("figure_id").distinct()


def upsert_last(base: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """base with the last change of each key in place of its row; other rows stay."""
    w = W.partitionBy(*keys).orderBy(F.desc(order))
    new = changes.withColumn("_i", F.row_number().over(w)).filter("_i = 1").select(*base.columns)
    return base.join(new.select(*keys), keys, "left_anti").unionByName(new)
