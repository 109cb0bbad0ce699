"""The inbox: names of archive members, metadata, handles, identifiers, references and their checks."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T

# Image folders by preference, products by file name.
IMAGE_FOLDERS = ("images", "image", "imgs")
PRODUCTS = {"full.md": "markdown", "layout.json": "layout_json", "middle.json": "middle_json", "full.html": "html", "full.tex": "latex", "main.tex": "latex", "result.docx": "docx"}


def data_id(name: Column, sha: Column) -> Column:
    """File name with odd characters replaced, and the beginning of its digest."""
    return F.concat(F.regexp_replace(name, r"[^\p{L}\p{N}.-]", "_"), F.lit("-"), T.or_default(F.substring(sha, 1, 12), "noid"))


def task_id(name: Column, sha: Column) -> Column:
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return F.concat(F.regexp_replace(stem, r"[^\p{L}\p{N}_-]", "_"), F.lit("-"), T.or_default(F.substring(sha, 1, 8), "noid"))


def contract_names(files: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """task_id, contract, name: the file that stands for each contract name: itself, else the first alias present.

    files: task_id, name. aliases: contract name -> other names, by preference.
    """
    ranks = [(c, n, k) for c, names in aliases.items() for k, n in enumerate((c, *names))]
    table = files.sparkSession.createDataFrame(ranks, "contract string, name string, rank int")
    return files.select("task_id", "name").join(F.broadcast(table), "name").groupBy("task_id", "contract").agg(F.min_by("name", "rank").alias("name"))


def image_folder(files: DataFrame) -> DataFrame:
    """task_id, folder: the preferred image folder that holds a file. files: task_id, path (within the task)."""
    first = F.get(F.split("path", "/"), 0)
    rank = F.lit(None).cast("int")
    for k, name in enumerate(IMAGE_FOLDERS):
        rank = F.when(first == name, k).otherwise(rank)
    return files.filter(F.contains("path", F.lit("/"))).select("task_id", first.alias("folder"), rank.alias("rank")).filter(F.col("rank").isNotNull()).groupBy("task_id").agg(F.min_by("folder", "rank").alias("folder"))


def inbox_meta(files: DataFrame, products: dict[str, str] = PRODUCTS) -> DataFrame:
    """task_id, slug, products (product -> file name): files has task_id, name, original_filename."""
    table = files.sparkSession.createDataFrame([(n, p, k) for k, (n, p) in enumerate(products.items())], "name string, product string, rank int")
    known = files.select("task_id", "name").join(F.broadcast(table), "name").groupBy("task_id", "product").agg(F.max_by("name", "rank").alias("name"))
    listed = known.groupBy("task_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("product", "name")))).alias("products"))
    slug = T.or_default(T.slug(F.regexp_replace("original_filename", r"\.[^.]*$", "")), "task")
    return files.groupBy("task_id").agg(F.max("original_filename").alias("original_filename")).join(listed, "task_id", "left").select("task_id", slug.alias("slug"), "products")


def folder_fingerprint(files: DataFrame, key: str = "task_id") -> DataFrame:
    """key, fingerprint: SHA-256 over path and size of the files in the order of their paths; contents do not count."""
    line = F.concat_ws(":", "path", F.col("length").cast("string"))
    return files.groupBy(key).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", line.alias("line")))), lambda x: x["line"]), "\n"), 256).alias("fingerprint"))


def local_reference(ref: Column) -> Column:
    """The path within the task of a relative reference, dots resolved; null for URLs, absolute paths and paths that leave the task."""
    step = lambda acc, part: F.when(part.isin("", "."), acc).when((part == "..") & (F.size(acc) > 0) & (F.element_at(F.concat(acc, F.array(F.lit(""))), F.greatest(F.size(acc), F.lit(1))) != ".."), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(part)))
    parts = F.aggregate(F.split(ref, "/"), F.array().cast("array<string>"), step)
    inside = (F.size(parts) > 0) & (F.get(parts, 0) != "..")
    relative = ~ref.rlike("^(https?|file)://") & (ref.startswith("images/") | ref.startswith("./") | ~F.contains(ref, F.lit("/")))
    return F.when(relative & inside, F.array_join(parts, "/"))


def check_references(refs: DataFrame, files: DataFrame) -> DataFrame:
    """task_id, total, remote, local, resolved, unreachable, severity of image references (task_id, ref); files: task_id, path.

    Remote ones need the shape of a URL, others of images/ must be there; anything else is an error.
    """
    here = files.select("task_id", F.col("path").alias("ref"), F.lit(True).alias("_there")).distinct()
    rows = refs.join(here, ["task_id", "ref"], "left")
    remote, local = F.col("ref").rlike("^https?://"), F.col("ref").startswith("images/")
    there = local & F.coalesce("_there", F.lit(False))
    good = F.when(remote, (F.length("ref") >= 10) & ~F.contains("ref", F.lit(" "))).otherwise(there)
    n = lambda c, name: F.count_if(c).alias(name)
    out = rows.groupBy("task_id").agg(F.count(F.lit(1)).alias("total"), n(remote, "remote"), n(local, "local"), n(there, "resolved"), n(~good, "unreachable"))
    return out.withColumn("severity", F.when(F.col("unreachable") > 0, "error").otherwise("ok"))


def save_handle(path: str, handle: dict) -> None:
    """Keep the handle of a submission beside its task."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(handle, ensure_ascii=False, sort_keys=True), encoding="utf-8")


def load_handle(path: str) -> dict | None:
    """The handle, or None where there is none that can be read."""
    try:
        got = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None
    return got if isinstance(got, dict) else None


def clear_handle(path: str) -> None:
    Path(path).unlink(missing_ok=True)
