"""Noise rules, pre-filter rules, gates and health checks, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Publisher phrases, lone symbols.
WATERMARKS = ("微信公众号 教辅资料站", "微信公众号", "教辅资料站", "学而思", "新东方", "高思教育")
SYMBOLS = "#@$%&*?/\\|<>~^`"


def noise_reason(title: Column, text: Column, min_body: int = 30, watermarks: Sequence[str] = WATERMARKS) -> Column:
    """Why an item is noise, or null: the first rule that holds decides."""
    t, body = F.trim(F.coalesce(title, F.lit(""))), F.trim(F.coalesce(text, F.lit("")))
    short = F.length(body) < min_body
    no_title = t == ""
    trivial = (body == "") | ((F.length(body) <= 3) & ~body.rlike(r"[\p{L}\p{N}]"))
    marked = F.lit(False)
    for phrase in watermarks:
        marked = marked | F.contains(t, F.lit(phrase))
    bare = F.replace(t, F.lit("-"), F.lit(""))
    pages = (F.length(t) <= 5) & (F.length(t) - F.length(bare) == 1) & bare.rlike("^[0-9]+$") & short
    return (
        F.when(no_title & trivial, "empty")
        .when(no_title, F.lit(None).cast("string"))
        .when(marked, "watermark")
        .when((F.length(t) == 1) & F.contains(F.lit(SYMBOLS), t), "symbol")
        .when(t.rlike("^[A-Za-z]$") & short, "letter")
        .when(t.rlike(r"^\p{Nd}{1,3}$"), "number")
        .when(t.rlike("^[\\x00-\\x7F]{1,2}$") & ~t.rlike("^[0-9]+$") & short, "short")
        .when(pages, "page_range")
    )


def partition_noise(items: DataFrame, title: str = "title", text: str = "text", **options) -> DataFrame:
    """items with is_noise and noise_reason."""
    reason = noise_reason(F.col(title), F.col(text), **options)
    return items.withColumn("noise_reason", reason).withColumn("is_noise", F.col("noise_reason").isNotNull())


def first_approved(rules: list[tuple[str, Column]], approved: Sequence[str]) -> dict[str, Column]:
    """What a list of rules decides when only approved rules may: the first approved rule that fires.

    Returns `decision` (its id or null), `fired` (ids of the rules that were tried and fired) and `deferred` (tried
    and did not fire); rules after the decision are not tried.
    """
    entry = lambda k, name, fires: F.struct(F.lit(k).alias("k"), F.lit(name).alias("id"), F.coalesce(fires, F.lit(False)).alias("fires"), F.lit(name in approved).alias("may"))
    every = F.array(*[entry(k, name, fires) for k, (name, fires) in enumerate(rules)])
    deciding = F.get(F.filter(every, lambda r: r["fires"] & r["may"]), 0)
    last = F.coalesce(deciding["k"], F.lit(len(rules)))
    tried = F.filter(every, lambda r: r["k"] <= last)
    ids = lambda keep: F.transform(F.filter(tried, keep), lambda r: r["id"])
    return {"decision": deciding["id"], "fired": ids(lambda r: r["fires"]), "deferred": ids(lambda r: ~r["fires"])}


def image_rules(context: Column, width: Column, height: Column, phrases: Sequence[str], min_area: int = 10_000, max_aspect: float = 5.0) -> list[tuple[str, Column]]:
    """The pre-filter rules: a phrase in the context, a tiny picture, an extreme aspect ratio (a side of 0 is extreme)."""
    said = F.lit(False)
    for p in phrases:
        said = said | F.contains(context, F.lit(p))
    short = F.least(width, height)
    aspect = F.coalesce(F.try_divide(F.greatest(width, height), short) > max_aspect, short == 0)
    return [("phrase", said), ("tiny", width * height < min_area), ("aspect", aspect)]


def health(docs: DataFrame, text: str = "text", min_chars: int = 50, many_lines: int = 10, max_short: float = 0.6) -> DataFrame:
    """doc_id, chars, lines, short_lines, severity and messages of each document."""
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    out = docs.select("doc_id", F.length(F.trim(F.coalesce(F.col(text), F.lit("")))).alias("chars"), F.size(lines).alias("lines"), F.size(F.filter(lines, lambda x: F.length(x) <= 2)).alias("short_lines"), F.exists(lines, lambda x: x.rlike("^#{1,6} ")).alias("headed"))
    tests = [("error:too_short", F.col("chars") < min_chars), ("info:no_heading", ~F.col("headed")), ("warning:fragmented", (F.col("lines") > many_lines) & (F.col("short_lines") > F.col("lines") * max_short))]
    found = F.array_compact(F.array(*[F.when(c, m) for m, c in tests]))
    out = out.withColumn("messages", F.array_join(found, ","))
    severity = F.when(F.contains("messages", F.lit("error:")), "error").when(F.contains("messages", F.lit("warning:")), "warning").otherwise("ok")
    return out.select("doc_id", "chars", "lines", "short_lines", severity.alias("severity"), "messages")


def asset_gate(path: Column, exists: Column, bytes_: Column, width: Column, height: Column, magic: Column, max_bytes: int = 10_000_000, max_pixels: int = 25_000_000) -> Column:
    """Why an image may not go to a model, or null. `magic` is its format by content."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    form = F.when(ext == "jpg", "jpeg").otherwise(ext)
    return (
        F.when(~ext.isin("png", "jpg", "jpeg", "webp"), "suffix")
        .when(~exists, "missing")
        .when(bytes_ > max_bytes, "too_many_bytes")
        .when(magic.isNull() | (width <= 0), "undecodable")
        .when(~magic.isin("png", "jpeg", "webp"), "format")
        .when(magic != form, "suffix_differs")
        .when(width.cast("long") * height > max_pixels, "too_many_pixels")
    )


def magic_of(content: Column) -> Column:
    """Image format by its first bytes, or null."""
    head = F.hex(F.substring(content, 1, 12))
    return F.when(head.startswith("89504E470D0A1A0A"), "png").when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("47494638"), "gif").when(head.startswith("52494646") & head.endswith("57454250"), "webp").when(head.startswith("424D"), "bmp")


def model_gate(relations: Column, observations: Column, low: float = 0.5) -> Column:
    """Whether a figure's facts call for a model, and why: struct<call, reason>; relations is array<struct<evidence, confidence>>."""
    answer = lambda call, why: F.struct(F.lit(call).alias("call"), F.lit(why).alias("reason"))
    some, seen = F.coalesce(F.size(relations), F.lit(0)) > 0, F.coalesce(F.size(observations), F.lit(0)) > 0
    firm = F.filter(relations, lambda r: ~r["evidence"].isin("visual_inference", "unknown"))
    return (
        F.when(~some & ~seen, answer(True, "rules_blank"))
        .when(~some, answer(True, "rules_blank_no_relations"))
        .when(F.size(firm) == 0, answer(True, "rules_only_non_promotable"))
        .when(F.exists(firm, lambda r: r["confidence"] < low), answer(True, "rules_low_confidence"))
        .when(seen, answer(True, "rules_have_visual_observations"))
        .otherwise(answer(False, "rules_sufficient"))
    )


def pages_used(use: DataFrame) -> DataFrame:
    """day, pages of each UTC day: use has ts and pages; negative pages count nothing."""
    return use.groupBy(F.to_date("ts").alias("day")).agg(F.sum(F.greatest(F.lit(0), F.col("pages"))).alias("pages"))


def quota_decision(state_day: Column, today: Column, used: Column, limit: Column, estimate: Column) -> Column:
    """ALLOW, REFUSE_PRE or WARN_LIVE before a submission; what was used on another day does not count."""
    now = F.when(state_day == today, used).otherwise(0)
    return F.when(estimate.isNull(), F.when(now >= limit, "REFUSE_PRE").otherwise("WARN_LIVE")).when(estimate <= 0, "ALLOW").when(now + estimate > limit, "REFUSE_PRE").otherwise("ALLOW")


def asset_problem(mime: Column, content: Column, min_bytes: int = 32) -> Column:
    """Why downloaded bytes are no asset, or null: type, size, then whether they begin like an image."""
    known = F.lit(False)
    for m in ("image/png", "image/jpeg", "image/jpg", "image/webp", "image/gif"):
        known = known | F.coalesce(mime, F.lit("")).startswith(m)
    return F.when(~known, "unsupported MIME type").when(F.octet_length(content) < min_bytes, "content too small").when(magic_of(content).isNull(), "not a decodable image")


def mock_role(context: Column, heading: Column, body_chars: Column, width: Column, height: Column, templated: Column, phrases: Sequence[str] = WATERMARKS) -> Column:
    """A deterministic stand-in for a role model: struct<role, confidence, reason>."""
    said = F.lit(False)
    for p in phrases:
        said = said | F.contains(context, F.lit(p))
    answer = lambda r, c, why: F.struct(F.lit(r).alias("role"), F.lit(c).alias("confidence"), F.lit(why).alias("reason"))
    aspect = width / height
    return (
        F.when(said, answer("decor", 0.95, "watermark"))
        .when(F.coalesce(heading, F.lit("")).rlike("栏目|专栏|banner") & (body_chars < 80), answer("decor", 0.86, "banner"))
        .when(templated, answer("decor", 0.84, "template"))
        .when(width * height < 10_000, answer("decor", 0.78, "tiny"))
        .when((aspect > 5) | (aspect < 0.2), answer("decor", 0.82, "aspect"))
        .otherwise(answer("content", 0.6, "default"))
    )


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key; `order` must be total."""
    w = W.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return rows.withColumn("_i", F.row_number().over(w)).filter("_i = 1").drop("_i")
