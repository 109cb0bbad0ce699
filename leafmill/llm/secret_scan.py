"""Secret scanning: Aho-Corasick keyword prefilter, anchored expressions near hits, embedded checksums.

One automaton pass over each text finds the keywords of all rules; a rule's expression is tried only at its hits.
Runs of hex digits have no keyword: their prefilter is a byte-class translation and a search for 16 in a row.
Tokens that carry a checksum (a four-letter prefix, 30 base-62 characters and a base-62 CRC-32 in 6 characters)
count only if the checksum is right.
Kinds, in order: assign, access, hex (base), then checked. Spans are code points, end exclusive.
Edge cases: a null text is empty and has no spans; long texts are read whole; extra columns pass through, and the
output columns replace columns of the same name; rows are never merged, so repeated rows give repeated results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "checked")
BASE = KINDS[:3]
# Keywords and prefixes.
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
HEX = re.compile(rb"[0-9a-f]{16,}")
_RUN = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_SIXTEEN = b"\x01" * 16
_B62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """CRC-32 of body as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _B62[r] + out
    return out


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_KEYWORDS), ("access", ("akia",)), ("checked", CHECKED_PREFIXES)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def find_spans(text: str | None, a: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of every span, sorted."""
    if not text:
        return []
    flat = text.encode("latin-1", "replace")  # one byte for each code point
    out, free = [], {"assign": 0, "access": 0, "checked": 0}
    for start, kind in sorted({(end - n + 1, kind) for end, (kind, n) in a.iter(flat.lower().decode("latin-1"))}):
        if start < free[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, start)
            good = m and len(m[2]) >= 12
        elif kind == "access":
            m = ACCESS.match(text, start)
            good = m and m.end() - start >= 18
        else:
            m = CHECKED.match(text, start)
            good = m and checksum62(m[1]) == m[2]
        if m:
            free[kind] = m.end()
        if good:
            out.append((start, KINDS.index(kind), m.end()))
    if (at := flat.translate(_RUN).find(_SIXTEEN)) >= 0:
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(flat, at)]
    return sorted(out)


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def scan_secrets(docs: DataFrame, text: str = "text", redact: str | None = None) -> DataFrame:
    """docs with spans: array<struct<kind, start, end>>; with `redact`, text has that mark in place of each span."""

    @F.pandas_udf("spans string, text string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = automaton()
        for part in batches:
            found = [find_spans(t, a) for t in part]
            new = [redact_text(t, s, redact) if s and redact is not None else None for t, s in zip(part, found, strict=True)]
            yield pd.DataFrame({"spans": [",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in s) for s in found], "text": pd.Series(new, dtype=object)})

    out = docs.withColumn("_found", scan.asNondeterministic()(F.col(text)))
    parts = lambda s: F.split(s, ":")
    listed = F.when(F.col("_found.spans") == "", F.array().cast("array<string>")).otherwise(F.split("_found.spans", ","))
    spans = F.transform(listed, lambda s: F.struct(parts(s)[0].alias("kind"), parts(s)[1].cast("int").alias("start"), parts(s)[2].cast("int").alias("end")))
    new = {"spans": spans} | ({text: F.coalesce(F.col("_found.text"), F.col(text))} if redact is not None else {})
    return out.withColumns(new).drop("_found")


def span_text(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(n, BASE), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"), n("checked"))
