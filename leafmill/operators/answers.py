"""Answers of models: unwrapping of provider bodies, parsing of relations, canonical hashes of inputs and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators.facts import RULES

_RELATION = "type string, entities array<string>, confidence string, observation string"


def block_text(body: Column) -> Column:
    """The text blocks of a body whose content is a list of blocks, one a line; empty where there are none."""
    content = F.transform(F.from_json(F.get_json_object(body, "$.content"), "array<string>"), lambda b: F.from_json(b, "type string, text string"))
    good = F.filter(content, lambda b: (b["type"] == "text") & (F.coalesce(b["text"], F.lit("")) != ""))
    return F.coalesce(F.array_join(F.transform(good, lambda b: b["text"]), "\n"), F.lit(""))


def choice_text(body: Column) -> Column:
    """The message of the first choice, whether or not the body lies in an envelope called data; empty where there is none."""
    inner = F.coalesce(F.get_json_object(body, "$.data"), body)
    return F.coalesce(F.get_json_object(inner, "$.choices[0].message.content"), F.lit(""))


def _score(raw: Column) -> Column:
    """A number in [0, 1]; absent, empty and truth values are 0; null where it is none."""
    clean = T.strip(F.coalesce(raw, F.lit("")))
    v = clean.try_cast("double")
    return F.when(clean.isin("", "true", "false"), 0.0).when(v.isNull() | (F.abs(v) == float("inf")), None).when(F.isnan(v), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def parse_answers(answers: DataFrame, raw: str = "raw", types: tuple[str, ...] = tuple(RULES)) -> DataFrame:
    """answers with relations array<struct<type, entities, confidence, observation>>, observations, invalid and error.

    Code fences go; a body that is no JSON object gives an error and no relations; relations of an unknown type, without
    entities or with a confidence that is no number are dropped and counted. Entities are trimmed and upper-cased.
    """
    text = T.strip(F.coalesce(F.col(raw), F.lit("")))
    clean = T.strip(F.when(text.startswith("```"), F.regexp_replace(text, r"^```(?:json)?\s*|\s*```$", "")).otherwise(text))
    body = F.from_json(clean, "relations string, observations string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    whole = clean.startswith("{") & F.coalesce(body["_bad"].isNull(), F.lit(False))
    listed = F.when(whole, F.from_json(body["relations"], "array<string>"))
    each = F.transform(listed, lambda x: F.from_json(x, _RELATION))
    names = lambda r: F.filter(F.transform(r["entities"], lambda e: F.upper(T.strip(e))), lambda e: e != "")
    made = F.transform(each, lambda r: F.struct(r["type"].alias("type"), names(r).alias("entities"), _score(r["confidence"]).alias("confidence"), T.strip(F.coalesce(r["observation"], F.lit(""))).alias("observation")))
    good = F.filter(made, lambda r: r["type"].isin(*types) & (F.coalesce(F.size(r["entities"]), F.lit(0)) > 0) & r["confidence"].isNotNull())
    invalid = F.coalesce(F.size(listed) - F.size(good), F.lit(0))
    error = F.when(text == "", "empty response").when(clean == "", "empty response after code fence strip").when(~whole, "response is not a JSON object").when(invalid > 0, F.concat(F.lit("discarded "), invalid.cast("string"), F.lit(" invalid relation(s)"))).otherwise("")
    empty = F.array().cast("array<struct<type:string,entities:array<string>,confidence:double,observation:string>>")
    said = F.coalesce(F.when(whole, F.from_json(body["observations"], "array<string>")), F.array().cast("array<string>"))
    return answers.withColumns({"relations": F.coalesce(good, empty), "observations": said, "invalid": invalid, "error": error})


def canonical(*columns: str) -> Column:
    """A row's columns as JSON with sorted keys and no white space; nulls are written."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def inputs_hash(candidates: DataFrame, key: str, order: tuple[str, ...] = ("asset_id", "item_id", "context_hash"), columns: tuple[str, ...] = ("asset_content_hash", "asset_id", "context_hash", "context_text", "height", "item_id", "width")) -> DataFrame:
    """key, inputs_hash: SHA-256 of the JSON list of the candidates of each run, sorted by `order`."""
    rows = candidates.select(key, F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], canonical(*columns).alias("json")).alias("r"))
    listed = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["json"]), ","), F.lit("]"))
    return rows.groupBy(key).agg(F.sha2(listed, 256).alias("inputs_hash"))


def rules_hash(config: dict) -> str:
    """SHA-256 of a rules configuration (schema_version, rules with rule_id, enabled_rules), whatever the order of its lists."""
    import hashlib
    import json

    body = {"schema_version": config["schema_version"], "rules": sorted(config["rules"], key=lambda r: r["rule_id"]), "enabled_rules": sorted(config["enabled_rules"])}
    return hashlib.sha256(json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False).encode()).hexdigest()
