"""Column builders for Markdown and OCR text. All are built-in expressions; none needs Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE = r"!\[([^\]]*)\]\([^)]+\)"
STRUCTURE_MARKS = "[*_~]+"
# An image in Markdown (its target in angle brackets or plain, with or without a title), and format marks.
MARKDOWN_IMAGE = r"""!\[[^\]]*\]\(\s*(?:<([^>]+)>|([^\s)]+))(?:\s+['"][^'"]*['"])?\s*\)"""
FORMAT_MARKS = r"[`*_~>#\[\]()]"


def strip(x: Column) -> Column:
    """x without white space (Unicode) at its ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def image_alt(x: Column) -> Column:
    """Image markers become their alternative text."""
    return F.regexp_replace(x, IMAGE, "$1")


def searchable(x: Column) -> Column:
    return F.lower(image_alt(x))


def normalized(x: Column) -> Column:
    """Without images, code fences and inline code; white space collapsed; lower case."""
    plain = F.regexp_replace(F.regexp_replace(image_alt(x), r"(?s)```.*?```", " "), "`[^`]*`", " ")
    return F.lower(strip(F.regexp_replace(plain, r"(?U)\s+", " ")))


def structure_normalized(x: Column) -> Column:
    return strip(F.regexp_replace(normalized(x), STRUCTURE_MARKS, ""))


def tokens(x: Column) -> Column:
    """Distinct words of two characters or more."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(x, r"(?U)[^\w]+", " "), " +"), lambda t: F.length(t) >= 2))


def first_sentence(x: Column, limit: int = 40) -> Column:
    return F.substring(strip(F.get(F.split(x, "[。！？!?.]", 2), 0)), 1, limit)


def text_chars(markdown: Column) -> Column:
    """Number of characters that are text: no images, link targets, format marks or white space."""
    out = F.regexp_replace(F.regexp_replace(markdown, "(?U)" + MARKDOWN_IMAGE, ""), r"\[([^\]]+)\]\([^)]+\)", "$1")
    return F.length(F.regexp_replace(F.regexp_replace(out, FORMAT_MARKS, ""), r"(?U)\s+", ""))


def without_image_markers(x: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(x, r"!\[image\]\([^)]*\)", ""), r"\n{3,}", "\n\n"))


def basename(x: Column) -> Column:
    """Last segment of a path or URL, without query and fragment."""
    return F.element_at(F.split(F.translate(F.get(F.split(x, "[?#]", 2), 0), "\\", "/"), "/"), -1)


def url_path(x: Column) -> Column:
    """Decoded path of a URL or file name, without scheme, host and query."""
    bare = F.regexp_replace(F.get(F.split(x, "[?#]", 2), 0), "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.url_decode(F.translate(bare, "\\", "/"))


def image_identity(x: Column) -> Column:
    """(path, stem) of an image target, without angle brackets, query and fragment."""
    bare = F.get(F.split(F.regexp_replace(strip(x), "^[<>]+|[<>]+$", ""), "[?#]", 2), 0)
    path = F.regexp_replace(F.translate(bare, "\\", "/"), "^[./]+", "")
    return F.struct(path.alias("path"), F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "").alias("stem"))


def local_context(text: Column, marker: Column, window: int = 200) -> Column:
    """The text around the first place of marker, `window` characters to each side; null where it is absent."""
    at = F.position(marker, text)
    start = F.greatest(F.lit(1), at - window)
    return F.when(at > 0, F.substring(text, start, at - start + F.length(marker) + window))


def block_order(block_id: Column) -> Column:
    """(page, block) of ids such as p001-b007; ids of another form come last."""
    number = lambda k: F.coalesce(F.regexp_extract(block_id, r"^p(\d+)-b(\d+)", k).try_cast("bigint"), F.lit(1_000_000_000))
    return F.struct(number(1).alias("page"), number(2).alias("block"))


def source_order(item_id: Column) -> Column:
    """First run of digits of an id, or one thousand million."""
    return F.coalesce(F.regexp_extract(item_id, r"(\d+)", 1).try_cast("bigint"), F.lit(1_000_000_000))


def short_hash(*parts: Column, prefix: str = "fig-", length: int = 12) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, length))


def relation_key(kind: Column, entities: Column) -> Column:
    """Type and the sorted lower-cased entities: the same for any order of the entities."""
    return F.concat(kind, F.lit("::"), F.array_join(F.array_sort(F.transform(entities, lambda e: F.lower(e))), "+"))


def locale_of(x: Column) -> Column:
    return F.when(x.rlike("[㐀-鿿]"), "zh").otherwise("en")


def slug(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(x, "[^A-Za-z0-9一-鿿]+", "-")), "^-+|-+$", "")


def plan_filename(topic: Column, mode: Column, sequence: Column) -> Column:
    return F.format_string("%s-%s-%03d.pdf", topic, mode, sequence)


def json_object(x: Column) -> Column:
    """The first {...} of a model's answer, code fences removed."""
    return F.regexp_extract(F.regexp_replace(x, "```[a-z]*", ""), r"(?s)(\{.*\})", 1)


def confidence(x: Column) -> Column:
    """A number in [0, 1]; anything else is 0."""
    v = x.try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def role(x: Column) -> Column:
    clean = F.lower(strip(x))
    return F.when(clean.isin("content", "decor"), clean).otherwise("ambiguous")


def or_default(x: Column, default) -> Column:
    """x unless it is null, empty or zero."""
    empty = F.lit("") if isinstance(default, str) else F.lit(0)
    return F.coalesce(F.nullif(x, empty), F.lit(default))


def meta_block(**fields: Column) -> Column:
    """One [name: value] line for each non-empty field."""
    lines = [F.when(F.length(v) > 0, F.concat(F.lit(f"[{k}: "), v, F.lit("]"))) for k, v in fields.items()]
    return F.concat_ws("\n", *lines)


def meta_field(block: Column, name: str) -> Column:
    return F.regexp_extract(block, rf"(?m)^\[{name}: (.*)\]$", 1)


def mime_of(path: Column) -> Column:
    """MIME type by file extension."""
    # Image types.
    known = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "bmp": "image/bmp", "svg": "image/svg+xml"}
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    out = F.lit("application/octet-stream")
    for k, v in known.items():
        out = F.when(ext == k, v).otherwise(out)
    return out
