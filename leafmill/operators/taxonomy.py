"""Score items against a topic outline: stop-word scrub, keyword and pattern hits, vetoes, top topics."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from leafmill.functions import text as T

NO_TOPIC = "_misc"


@dataclass
class Topic:
    """A leaf with its rules; stopwords include those of its ancestors."""

    topic_id: str
    keywords: list[str] = field(default_factory=list)
    patterns: list[str] = field(default_factory=list)
    negative_keywords: list[str] = field(default_factory=list)
    negative_patterns: list[str] = field(default_factory=list)
    stopwords: list[str] = field(default_factory=list)
    priority: int = 0
    path: list[str] = field(default_factory=list)
    label: str = ""


def load_outline(data: dict) -> list[Topic]:
    """Leaves of an outline in declaration order; bad outlines raise ValueError."""
    seen: set[str] = set()
    out: list[Topic] = []
    rules = dict(data.get("vocabulary") or {})

    def walk(node: dict, path: list[str], stop: list[str]) -> None:
        name = node.get("id", "")
        if not re.fullmatch(r"[a-z0-9]+(?:-[a-z0-9]+)*", name):
            raise ValueError(f"bad topic id: {name!r}")
        if name in seen:
            raise ValueError(f"topic id twice: {name}")
        seen.add(name)
        stop = list(dict.fromkeys([*stop, *node.get("chapter_stopwords", [])]))
        children = node.get("children") or []
        if children and name in rules:
            raise ValueError(f"vocabulary on an interior topic: {name}")
        for c in children:
            walk(c, [*path, name], stop)
        if not children:
            v = rules.get(name, {})
            for p in [*v.get("patterns", []), *v.get("negative_patterns", [])]:
                try:
                    re.compile(p)
                except re.error as e:
                    raise ValueError(f"bad pattern of {name}: {p}") from e
            out.append(Topic(name, v.get("keywords", []), v.get("patterns", []), v.get("negative_keywords", []), v.get("negative_patterns", []), stop, int(v.get("priority", 0)), [*path, name], node.get("label", name)))

    for t in data.get("topics") or []:
        walk(t, [], [])
    if unknown := set(rules) - seen:
        raise ValueError(f"vocabulary of unknown topics: {sorted(unknown)}")
    for mode in [data.get("strategy", {}).get("default", "A"), *data.get("strategy", {}).get("overrides", {}).values()]:
        if mode not in ("A", "B", "C"):
            raise ValueError(f"bad mode: {mode}")
    return out


def scrubbed(text: Column, stopwords: list[str]) -> Column:
    """text with each stop word replaced by as many spaces, one after the other."""
    for word in stopwords:
        text = F.replace(text, F.lit(word.lower()), F.lit(" " * len(word)))
    return text


def _any(text: Column, words: list[str], patterns: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w.lower()))
    for p in patterns:
        hit = hit | text.rlike(f"(?U){p}")
    return hit


def topic_score(text: Column, topic: Topic, min_score: int = 1) -> Column:
    """Keyword hits (on scrubbed text, each listed keyword counts) and distinct pattern hits; a veto loses."""
    clean = scrubbed(text, topic.stopwords)
    hits = [F.contains(clean, F.lit(k.lower())).cast("int") for k in topic.keywords] + [text.rlike(f"(?U){p}").cast("int") for p in dict.fromkeys(topic.patterns)]
    total = sum(hits, F.lit(0))
    return F.when(_any(text, topic.negative_keywords, topic.negative_patterns), F.lit(min_score - 1)).otherwise(total)


def match_scores(items: DataFrame, topics: list[Topic], key: list[str], text: str = "text", min_score: int = 1) -> DataFrame:
    """key, topic_id, score, priority, topic_order: one row for each item and topic with score >= min_score.

    Every rule is a literal expression in one projection, so an outline costs one pass over the items and no join.
    """
    items = items.select(*key, T.searchable(F.col(text)).alias("_s"))
    rows = [F.struct(F.lit(t.topic_id).alias("topic_id"), topic_score(F.col("_s"), t, min_score).alias("score"), F.lit(t.priority).alias("priority"), F.lit(i).alias("topic_order")) for i, t in enumerate(topics) if t.keywords or t.patterns or t.negative_keywords or t.negative_patterns]
    hits = F.filter(F.array(*rows), lambda r: r["score"] >= min_score)
    return items.select(*key, F.explode_outer(hits).alias("t")).filter(F.col("t").isNotNull()).select(*key, "t.*")


def top_topics(items: DataFrame, topics: list[Topic], key: list[str], max_topics: int = 4, **options) -> DataFrame:
    """key, topic_id, rank, score: at most max_topics an item, or _misc."""
    scores = match_scores(items, topics, key, **options)
    w = W.partitionBy(*key).orderBy(F.desc("score"), F.desc("priority"), "topic_order")
    best = scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max_topics).select(*key, "topic_id", "rank", "score")
    out = items.select(*key).join(best, key, "left")
    return out.select(*key, F.coalesce("topic_id", F.lit(NO_TOPIC)).alias("topic_id"), F.coalesce("rank", F.lit(1)).alias("rank"), F.coalesce("score", F.lit(0)).alias("score"))


def usage(assigned: DataFrame, key: list[str]) -> DataFrame:
    return assigned.groupBy("topic_id").agg(F.count_distinct(*key).alias("items"), F.sum("score").alias("total_score"))


def topics_frame(spark: SparkSession, topics: list[Topic]) -> DataFrame:
    rows = [(t.topic_id, t.label, t.priority, i, t.path) for i, t in enumerate(topics)]
    return spark.createDataFrame(rows, "topic_id string, label string, priority int, ord int, path array<string>")


def tree_paths(nodes: DataFrame) -> DataFrame:
    """(id, parent) -> (id, path from the root): a recursive query, one step a level."""
    nodes.createOrReplaceTempView("_leafmill_tree")
    return nodes.sparkSession.sql("""
        WITH RECURSIVE walk AS (
            SELECT id, array(id) AS path FROM _leafmill_tree WHERE parent IS NULL
            UNION ALL
            SELECT t.id, array_append(w.path, t.id) FROM _leafmill_tree t JOIN walk w ON t.parent = w.id
        ) SELECT id, path FROM walk""")


def common_ancestor(a: Column, b: Column) -> Column:
    """The last node that two paths share, or null."""
    n = F.array_max(F.filter(F.sequence(F.lit(1), F.least(F.size(a), F.size(b))), lambda i: F.slice(a, 1, i) == F.slice(b, 1, i)))
    return F.when(n > 0, F.element_at(a, F.coalesce(n, F.lit(1))))
