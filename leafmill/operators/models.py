"""Model calls behind an interface: figure roles with a cache and retries, and relations that a model adds to those of rules.

A provider is a callable (image bytes, prompt) -> answer text that raises where it fails. It runs in Python workers, `parallel`
calls at a time; everything around it is column functions and joins. No call is made for what the cache or the rules settle.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import answers, facts, quality
from leafmill.tables import materialize

Provider = Callable[[bytes, str], str]
CONTEXT = 8000  # characters of context in a prompt


def ask(rows: DataFrame, provider: Provider, retries: int = 2, backoff: float = 1.0, parallel: int = 8) -> DataFrame:
    """key, answer, error of rows (key, content, prompt): a failed call is tried again after a doubling pause and never raises."""
    if retries < 0 or backoff < 0:
        raise ValueError("retries and backoff must not be negative")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for key, content, prompt in zip(part["key"], part["content"], part["prompt"], strict=True):
                answer, error = None, ""
                for attempt in range(retries + 1):
                    try:
                        answer, error = provider(bytes(content), prompt), ""
                        break
                    except Exception as e:
                        error = str(e) or type(e).__name__
                        if attempt < retries:
                            time.sleep(backoff * 2**attempt)
                out.append((key, answer, error))
            yield pd.DataFrame(out, columns=["key", "answer", "error"])

    return rows.select("key", "content", "prompt").repartition(parallel).mapInPandas(work, "key string, answer string, error string")


def _digest(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def role_key(sha256: Column, context: Column, model: str, prompt: str) -> Column:
    """The name of an answer in the cache: the image, the model, the prompt and the context."""
    return _digest(F.concat_ws("|", sha256, F.lit(model), _digest(F.lit(prompt)), _digest(F.coalesce(context, F.lit("")))))


def annotate(candidates: DataFrame, provider: Provider, cache: DataFrame, prompt: str, model: str = "", **calls) -> tuple[DataFrame, DataFrame]:
    """(records, cache) for candidates (figure_id, item_id, asset_id, path, content, width, height, context).

    A record has role, confidence, reason, status. Content that is null or may not go to a model, a provider that fails and an answer
    without a role give the role ambiguous, so that the figure stays. Equal images in equal contexts are asked about once. The cache
    (key, role, confidence, reason) returns with the good answers of this run added.
    """
    sha = F.sha2("content", 256)
    rows = candidates.withColumns({"sha256": F.coalesce(sha, F.lit("")), "key": F.when(F.col("content").isNotNull(), role_key(sha, F.col("context"), model, prompt))})
    known = cache.select("key", F.struct("role", "confidence", "reason").alias("known")).dropDuplicates(["key"])
    rows = rows.join(known, "key", "left")
    gate = quality.asset_gate(F.col("path"), F.col("content").isNotNull(), F.octet_length("content"), F.col("width"), F.col("height"), quality.magic_of(F.col("content")))
    rows = rows.withColumn("gate", gate)
    wanted = rows.filter(F.col("key").isNotNull() & F.col("known").isNull() & F.col("gate").isNull())
    first = wanted.groupBy("key").agg(F.first("content").alias("content"), F.first(F.concat(F.lit(prompt), F.substring(F.coalesce("context", F.lit("")), 1, CONTEXT))).alias("prompt"))
    body = F.from_json(T.json_object(F.col("answer")), "role string, confidence string, reason string")
    got = ask(first, provider, **calls).withColumn("b", body)
    parsed = got.select("key", "error", F.when(F.col("b.role").isNotNull(), F.struct(T.role(F.col("b.role")).alias("role"), T.confidence(F.col("b.confidence")).alias("confidence"), F.coalesce("b.reason", F.lit("")).alias("reason"))).alias("new"))
    parsed = materialize(parsed)  # the calls are made once, whatever reads their answers
    unsure = lambda why: F.struct(F.lit("ambiguous").alias("role"), F.lit(0.0).alias("confidence"), why.alias("reason"))
    out = rows.drop("content").join(parsed, "key", "left")
    missing, failed = F.col("sha256") == "", F.coalesce("error", F.lit("")) != ""
    verdict = F.when(missing, unsure(F.lit("asset_unavailable"))).when(F.col("known").isNotNull(), F.col("known")).when(F.col("gate").isNotNull(), unsure(F.concat(F.lit("asset_rejected: "), "gate"))).when(failed, unsure(F.lit("provider_error"))).otherwise(F.coalesce("new", unsure(F.lit("schema_error"))))
    status = F.when(missing, "skipped").when(F.col("known").isNotNull(), "cached").when(F.col("gate").isNotNull(), "rejected").when(failed, "failed").otherwise("ok")
    records = out.withColumns({"v": verdict, "status": status, "model_id": F.lit(model)}).select("figure_id", "item_id", "asset_id", "sha256", "v.role", "v.confidence", "v.reason", "model_id", "status")
    added = parsed.filter(F.col("new").isNotNull()).select("key", "new.role", "new.confidence", "new.reason")
    return records, cache.select("key", "role", "confidence", "reason").unionByName(added)


def classify(candidates: DataFrame, provider: Provider, cache: DataFrame, prompt: str, uses: DataFrame | None = None, overrides: DataFrame | None = None, templates: DataFrame | None = None, prior: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """`annotate` over the candidates that plans use (uses: figure_id, item_id), that no one has decided (overrides: figure_id) and that
    are no repeated template (templates: asset_id). Records of `prior` stay where this run has none for the figure and item."""
    for table, keys, how in ((uses, ["figure_id", "item_id"], "left_semi"), (overrides, ["figure_id"], "left_anti"), (templates, ["asset_id"], "left_anti")):
        if table is not None:
            candidates = candidates.join(table, keys, how)
    records, cache = annotate(candidates, provider, cache, prompt, **options)
    return (records if prior is None else records.unionByName(prior.join(records, ["figure_id", "item_id"], "left_anti").select(*records.columns))), cache


def hybrid(figures: DataFrame, provider: Provider | None, prompt: str, name: str = "model", **calls) -> tuple[DataFrame, DataFrame]:
    """(relations, calls): the relations of rules, with those that a model adds where the rules are not sure.

    figures: figure_id, text, caption, content. An answer's relation that the rules have is dropped, one with their entities and
    another type has evidence unknown, any other visual_inference. calls: figure_id, status, reason, error. The relations of rules are
    read from the texts once and written, since the gate, the comparison and the result all take them.
    """
    rules = materialize(facts.relations(figures).select("figure_id", "type", "entities", "evidence", "confidence", "key", "review_state", F.lit("rules").alias("source")))
    some = rules.groupBy("figure_id").agg(F.collect_list(F.struct("evidence", "confidence")).alias("r"))
    seen = facts.observations(figures).groupBy("figure_id").agg(F.collect_list("observation").alias("o"))
    rows = figures.join(some, "figure_id", "left").join(seen, "figure_id", "left").withColumn("g", quality.model_gate(F.col("r"), F.col("o")))
    wants = F.col("g.call") & F.col("content").isNotNull() & F.lit(provider is not None)
    why = F.lit("no_provider") if provider is None else F.when(F.col("content").isNull(), "asset_unavailable").otherwise(F.col("g.reason"))
    made = rows.select("figure_id", wants.alias("asked"), why.alias("reason"))
    if provider is None:
        return rules, made.select("figure_id", F.lit("skipped").alias("status"), "reason", F.lit("").alias("error"))
    said = F.array_join(F.filter(F.array("text", "caption"), lambda x: F.coalesce(x, F.lit("")) != ""), "\n")
    question = rows.filter(wants).select(F.col("figure_id").cast("string").alias("key"), "content", F.concat(F.lit(prompt), F.substring(said, 1, CONTEXT)).alias("prompt"))
    got = materialize(answers.parse_answers(ask(question, provider, **calls).withColumnRenamed("error", "failure"), raw="answer"))
    own = figures.select("figure_id", F.col("figure_id").cast("string").alias("key")).join(got, "key").drop("key")
    new = own.filter("failure = ''").select("figure_id", F.posexplode("relations").alias("i", "x")).select("figure_id", "i", "x.type", "x.entities", "x.confidence")
    new = new.withColumn("key", T.relation_key(F.col("type"), F.col("entities")))
    new = quality.latest(new, ["figure_id", "key"], [-F.col("i")])  # the first of a key
    judged = facts.merge_candidates(rules, new).filter("verdict <> 'agree'")
    evidence = F.when(F.col("verdict") == "conflict", "unknown").otherwise("visual_inference")
    added = judged.select("figure_id", "type", "entities", evidence.alias("evidence"), "confidence", "key", F.lit("unreviewed").alias("review_state"), F.lit(name).alias("source"))
    told = made.join(own.select("figure_id", "failure"), "figure_id", "left")
    status = F.when(~F.col("asked"), "skipped").when(F.col("failure") != "", "failed").otherwise("ok")
    return rules.unionByName(added), told.select("figure_id", status.alias("status"), "reason", F.coalesce("failure", F.lit("")).alias("error"))
