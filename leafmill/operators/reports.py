"""Reports: counts and lists over relations, calls, roles, rules, topics and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.tables import replace


def _histogram(rows: DataFrame, keys: list[str], name: str, out: str) -> DataFrame:
    """keys and a map from name to its number of rows, by one count a name."""
    n = rows.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(name, F.lit("")), "_n"))))
    return n.groupBy(*keys).agg(entries.alias(out))


def relation_counts(edges: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, kinds: how many edges of each kind."""
    return _histogram(edges, [key], "kind", "kinds")


def geometry_report(figures: DataFrame, rels: DataFrame) -> DataFrame:
    """figures_total, figures_with_relations, relations_total, evidence_counts: one row."""
    total = figures.agg(F.count(F.lit(1)).alias("figures_total"))
    some = rels.agg(F.count_distinct("figure_id").alias("figures_with_relations"), F.count(F.lit(1)).alias("relations_total"))
    kinds = rels.groupBy("evidence").count().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("evidence", "count")))).alias("evidence_counts"))
    return total.crossJoin(some).crossJoin(kinds)  # three single rows


def call_summary(calls: DataFrame) -> DataFrame:
    """total, called, skipped, failed, rejected of model calls (status, skip_reason) and the reasons of skipped ones: one row."""
    status = F.coalesce("status", F.lit(""))
    n = lambda c, name: F.count_if(c).alias(name)
    counts = calls.agg(F.count(F.lit(1)).alias("total"), n(~status.isin("skipped", ""), "called"), n(status == "skipped", "skipped"), n(status == "failed", "failed"), n(status == "rejected", "rejected"))
    why = calls.filter((status == "skipped") & (F.coalesce("skip_reason", F.lit("")) != "")).groupBy("skip_reason").count()
    return counts.crossJoin(why.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("skip_reason", "count")))).alias("skip_reasons")))


def role_distribution(records: DataFrame) -> DataFrame:
    """role, n, percent (one decimal) of figure roles."""
    n = records.groupBy("role").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("_total"))
    return n.crossJoin(total).select("role", "n", F.round(F.col("n") * 100 / F.col("_total"), 1).alias("percent"))


def rule_report(decided: DataFrame, approved: list[str], key: Column) -> DataFrame:
    """rule_id, hits, defers, approved, saved_calls of pre-filter results (fired, deferred, decision); saved calls are the distinct keys it decided."""
    rows = decided.select(key.alias("_key"), "decision", F.explode(F.concat(F.transform("fired", lambda r: F.struct(r.alias("rule_id"), F.lit(1).alias("hit"))), F.transform("deferred", lambda r: F.struct(r.alias("rule_id"), F.lit(0).alias("hit"))))).alias("r"))
    saved = F.count_distinct(F.when(F.col("decision") == F.col("r.rule_id"), F.col("_key")))
    return rows.groupBy("r.rule_id").agg(F.sum("r.hit").alias("hits"), F.sum(1 - F.col("r.hit")).alias("defers"), saved.alias("saved_calls")).withColumn("approved", F.col("rule_id").isin(*approved) if approved else F.lit(False))


def match_report(assigned: DataFrame, none: str = "_misc") -> DataFrame:
    """items, classified, unclassified, share of assignments (item_id, topic_id): one row."""
    item = assigned.groupBy("item_id").agg(F.max((F.col("topic_id") != none).cast("int")).alias("known"))
    return item.agg(F.count(F.lit(1)).alias("items"), F.sum("known").alias("classified"), F.sum(1 - F.col("known")).alias("unclassified"), F.round(F.avg(1 - F.col("known")), 6).alias("share"))


def unclassified(assigned: DataFrame, none: str = "_misc") -> DataFrame:
    """item_id of items without a topic: a table, since there may be any number."""
    return assigned.filter(F.col("topic_id") == none).select("item_id").distinct()


def dropped_figures(lines: DataFrame) -> DataFrame:
    """plan_id, style, figures, uses of render lines that are not drawn; a figure that is missing twice counts as two uses."""
    out = lines.filter(F.col("style").isin("missing", "blocked", "dropped"))
    return out.groupBy("plan_id", "style").agg(F.count_distinct("content").alias("figures"), F.count(F.lit(1)).alias("uses"))


def export_manifest(files: DataFrame, checks: DataFrame) -> DataFrame:
    """plan_id, sha256, bytes, status of the files (plan_id, pdf, sha256) and their validation."""
    return files.select("plan_id", "sha256", F.octet_length("pdf").cast("long").alias("bytes")).join(checks, "plan_id", "left")


def review_queue(rels: DataFrame) -> DataFrame:
    """figure_id, entry: Markdown of the relations of each figure that wait for review, in the order of their keys."""
    line = F.concat(F.lit("- ["), F.col("review_state"), F.lit("] "), F.col("key"), F.lit(" ("), F.col("evidence"), F.lit(")"))
    rows = rels.filter(F.col("review_state") == "unreviewed").groupBy("figure_id").agg(F.array_sort(F.collect_list(F.struct("key", line.alias("line")))).alias("l"))
    return rows.select("figure_id", F.concat(F.lit("## "), F.col("figure_id").cast("string"), F.lit("\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("entry"))


def write_once(report: DataFrame, path: str) -> None:
    """Write a report as JSON; an earlier one stays and raises."""
    report.write.mode("errorifexists").json(path)


def saved_queue(path: str, figures: DataFrame, log: DataFrame, force: bool = False) -> None:
    """Write the figures of an extraction; with `force` the decision log is emptied too, since all review states begin anew."""
    figures.write.mode("overwrite").json(f"{path}/figures")
    if force:
        log.limit(0).write.mode("overwrite").json(f"{path}/decisions")


def write_plans(made: dict[str, DataFrame], folder: str) -> None:
    """Write what `planning.plan` made: plans and the pruning report always, the report of plans left out where there are any."""
    replace(made["plans"], f"{folder}/plans")
    replace(made["pruning"].filter("pruned"), f"{folder}/topic_pruning")
    if not made["superseded"].isEmpty():
        replace(made["superseded"], f"{folder}/plan_deduplication")
