"""Export plans: pruning, ordering, containment, bridges, figure back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import text as T
from leafmill.operators.quality import noise_reason
from leafmill.operators.taxonomy import NO_TOPIC, common_ancestor

# Order of item types.
PRIORITY = {"chapter": 0, "section": 1, "definition": 10, "theorem": 11, "method": 20, "knowledge_point": 25, "example": 30, "worked_example": 30, "exercise": 40, "solution": 50, "summary": 60, "chapter_summary": 60}


def type_priority(kind: Column, table: dict[str, int] = PRIORITY, other: int = 70) -> Column:
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def prune_topics(scores: DataFrame, key: list[str]) -> DataFrame:
    """key, topic_id, score, n_topics, pruned: where one topic of two or more has the greatest score alone, and none is
    the fallback, only that stays."""
    w = W.partitionBy(*key)
    top = F.max("score").over(w)
    out = scores.withColumns({"n_topics": F.count(F.lit(1)).over(w), "_top": top, "_misc": F.max((F.col("topic_id") == NO_TOPIC).cast("int")).over(w), "_null": F.max(F.col("score").isNull().cast("int")).over(w)})
    out = out.withColumn("_ties", F.sum((F.col("score") == F.col("_top")).cast("int")).over(w))
    out = out.withColumn("pruned", (F.col("n_topics") >= 2) & (F.col("_misc") == 0) & (F.col("_null") == 0) & (F.col("_ties") == 1))
    return out.filter(~F.col("pruned") | (F.col("score") == F.col("_top"))).drop("_top", "_misc", "_null", "_ties")


def effective_mode(requested: Column, topic_mode: Column, forced: Column, has_outline: Column) -> Column:
    return F.coalesce(forced, F.when((requested != "B") | ~has_outline, requested).otherwise(F.coalesce(topic_mode, requested)))


def plan_items(assigned: DataFrame, mode: Column | None = None) -> DataFrame:
    """plan_seq, topic_id, pos, item_id: plans in the order of topic ids, the fallback last; items by type priority,
    source order and position. assigned has topic_id, item_id, item_type, item_seq."""
    topics = assigned.select("topic_id").distinct().withColumn("misc", (F.col("topic_id") == NO_TOPIC).cast("int"))
    numbered = topics.withColumn("plan_seq", F.row_number().over(W.orderBy("misc", "topic_id"))).drop("misc")  # one row a topic
    by = W.partitionBy("topic_id").orderBy(type_priority(F.col("item_type")), T.source_order(F.col("item_id")), "item_seq")
    return assigned.withColumn("pos", F.row_number().over(by)).join(numbered, "topic_id").select("plan_seq", "topic_id", "pos", "item_id")


def superseded(items: DataFrame, plan: str = "plan_id", item: str = "item_id") -> DataFrame:
    """plan_id, by_plan: plans of one distinct item that a larger plan holds; the smallest such, then the first."""
    rows = items.select(plan, item).distinct()
    sizes = rows.groupBy(plan).agg(F.count(F.lit(1)).alias("n"), F.min(item).alias("only"))
    single = sizes.filter("n = 1").select(F.col(plan).alias("small"), F.col("only").alias(item))
    larger = rows.join(sizes.filter("n > 1").select(plan, "n"), plan)
    met = single.join(larger, item)
    return met.groupBy("small").agg(F.min(F.struct("n", plan)).alias("b")).select(F.col("small").alias(plan), F.col(f"b.{plan}").alias("by_plan"), F.col("b.n").alias("by_size"))


def adjacent(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """rows with the previous row's name."""
    return rows.withColumn(f"prev_{name}", F.lag(name).over(W.partitionBy(key).orderBy(order)))


def bridges(plans: DataFrame) -> DataFrame:
    """plan_id, kind, text of plans (plan_seq, plan_id, title, mode, path, keywords) in mode C after another plan."""
    w = W.orderBy("plan_seq")  # one row a plan
    rows = plans.withColumns({"p_title": F.lag("title").over(w), "p_path": F.lag("path").over(w)}).filter((F.col("mode") == "C") & F.col("p_title").isNotNull())
    shared = common_ancestor(F.col("p_path"), F.col("path"))
    words = F.slice(F.array_distinct(F.transform("keywords", lambda k: F.lower(k))), 1, 5)
    said = F.when(shared.isNotNull(), F.concat(F.lit("shared: "), shared)).when(F.size(words) > 0, F.concat(F.lit("next: "), F.array_join(words, ", ")))
    return rows.select("plan_id", F.when(said.isNotNull(), "outline").otherwise("outline-fallback").alias("kind"), F.coalesce(said, F.concat_ws(" -> ", "p_title", "title")).alias("text"))


def backfill(markers: DataFrame, assets: DataFrame, existing: DataFrame) -> DataFrame:
    """item_id, asset_id to add: markers (item_id, target) by file name, where the item lacks that asset."""
    names = assets.select(T.basename(F.col("local_path")).alias("name"), "asset_id", "ord").groupBy("name").agg(F.min_by("asset_id", "ord").alias("asset_id"))
    met = markers.withColumn("name", T.basename(F.col("target"))).join(names, "name").select("item_id", "asset_id").distinct()
    return met.join(existing, ["item_id", "asset_id"], "left_anti")


def is_intro(kind: Column) -> Column:
    """Chapter openings, which plans leave out."""
    return F.lower(T.strip(F.coalesce(kind, F.lit("")))) == "chapter"


def content_figures(records: DataFrame, overrides: DataFrame) -> DataFrame:
    """figure_id of the content figures: by record, then by the last override of each figure. records: figure_id, asset_id, role;
    overrides: figure_id, role, ord. An override speaks for the figure and for the assets that records tie to it."""
    ids = lambda df: df.select("figure_id", F.explode(F.array("figure_id", "asset_id")).alias("id")).filter(F.col("id").isNotNull() & (F.col("id") != ""))
    tied = ids(records).distinct()
    said = overrides.filter(F.col("role").isin("content", "decor")).groupBy("figure_id").agg(F.max_by("role", "ord").alias("role"), F.max("ord").alias("ord"))
    spoken = said.join(tied, "figure_id", "left").select(F.coalesce("id", "figure_id").alias("id"), "role", "ord")
    last = spoken.groupBy("id").agg(F.max_by("role", "ord").alias("role"))
    kept = ids(records.filter("role = 'content'")).select("id").distinct().join(last.filter("role = 'decor'"), "id", "left_anti")
    return kept.unionByName(last.filter("role = 'content'").select("id")).distinct().select(F.col("id").alias("figure_id"))


def content_rescue(items: DataFrame, assets: DataFrame, content: DataFrame) -> DataFrame:
    """items (item_id, item_type, title, text, pages) that plans keep: all but noise and chapter openings, and those of
    these that own a content figure, under the fallback topic (column topic_id, else null) with a reason and, for noise, a title of their own.

    assets: item_id, asset_id. content: asset_id.
    """
    owners = assets.join(content, "asset_id", "left_semi").select("item_id").distinct().withColumn("_owns", F.lit(True))
    noise, intro = noise_reason(F.col("title"), F.col("text")).isNotNull(), is_intro(F.col("item_type"))
    rows = items.join(owners, "item_id", "left").withColumns({"_noise": noise, "_out": noise | intro}).filter(~F.col("_out") | F.col("_owns"))
    head = T.strip(F.coalesce("title", F.lit("")))
    body = F.coalesce("text", F.lit(""))
    rest = F.when((head != "") & body.startswith(head), F.regexp_replace(F.substring(body, F.length(head) + 1, F.length(body)), r"(?U)^\s+", "")).otherwise(body)
    label = F.when(F.size("pages") > 0, F.concat(F.lit("内容图（源页 "), F.get("pages", 0).cast("string"), F.lit("）"))).otherwise(F.concat(F.lit("内容图（"), F.coalesce(F.nullif("item_id", F.lit("")), F.lit("未编号")), F.lit("）")))
    new = {"topic_id": F.when(F.col("_out"), NO_TOPIC), "reason": F.when(F.col("_noise"), "content_figure_on_noise_item").when(F.col("_out"), "content_figure_on_intro_item"), "title": F.when(F.col("_noise"), label).otherwise(F.col("title")), "text": F.when(F.col("_noise"), rest).otherwise(F.col("text"))}
    return rows.withColumns(new).drop("_noise", "_out", "_owns")


def first_use(uses: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """key, names: the distinct names of each key in the order of their first use."""
    firsts = uses.filter(F.col(name).isNotNull()).groupBy(key, name).agg(F.min(order).alias("_at"))
    return firsts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", name))), lambda x: x[name]).alias("names"))


def plan(items: DataFrame, scores: DataFrame, assets: DataFrame, content: DataFrame) -> dict[str, DataFrame]:
    """The planner: what to keep, pruned topics, ordered plans, plans that a larger one holds, figures in first-use order.

    items: item_id, item_type, item_seq, title, text, pages. scores: item_id, topic_id, score (the fallback where no topic fits).
    """
    kept = content_rescue(items, assets, content)
    pruned = prune_topics(scores, ["item_id"])
    usual = kept.filter(F.col("topic_id").isNull()).drop("topic_id").join(pruned.select("item_id", "topic_id"), "item_id", "left").withColumn("topic_id", F.coalesce("topic_id", F.lit(NO_TOPIC)))
    rows = usual.unionByName(kept.filter(F.col("topic_id").isNotNull()))
    plans = plan_items(rows.select("topic_id", "item_id", "item_type", "item_seq"))
    double = superseded(plans.select(F.col("topic_id").alias("plan_id"), "item_id"))
    live = plans.join(double.select(F.col("plan_id").alias("topic_id")), "topic_id", "left_anti")
    figures = first_use(live.join(assets, "item_id"), "topic_id", "pos", "asset_id")
    return {"items": rows, "pruning": pruned, "plans": live, "superseded": double, "figures": figures}
