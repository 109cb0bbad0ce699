"""Personal data: base patterns, and information-theoretic sanitisation of the terms that reveal them.

Base kinds are email, ip, card and phone. A protected entity is a distinct value of one of them. A term is a word of
two letters or more outside all base spans. With N rows, of which n_c hold entity c, n_t hold term t and n_tc hold both,
anywhere in their texts, the disclosure of t for c is PMI(c; t) / IC(c) = log(N n_tc / (n_t n_c)) / log(N / n_c):
the share of the entity's information that the term gives away. A pair is disclosed when that share is at least
`generalise_at`; a pair seen in fewer than `support` rows is too rare for the estimate and follows an exact rule: it is
disclosed when no row without the entity holds the term. All places of a disclosed term in the texts that hold the entity
become spans of kind `term`, which `sanitise` replaces by a general mark, or removes from `remove_at` on. Counts cover all rows.

Everything is built-in column functions; texts are read where they lie and never shuffled by `find`, but for those that
hold an entity (`sanitise` joins them to their spans). Terms that meet many entities are joined by broadcast, the others dealt by term.
Offsets are code points, end exclusive. Edge cases: a null text is empty; rows are never merged, so repeated rows
count and report again; an entity that all rows hold discloses nothing; an empty table gives no
rows; extra columns pass through `sanitise`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import content_key, materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive loops and the guards before a match leave the matches as they are and
# keep long runs linear; the card pattern meets only runs of 16 to 19 digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _part_fits(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(F.when(F.length(bare) <= 3, bare.try_cast("int")), F.lit(0)) <= 255)


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _part_fits)
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def located(text: Column, pattern: str | Column, kind: str) -> Column:
    """Spans of all matches of pattern: offsets are summed over the matches and the pieces between them."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    # the arrays travel in the accumulator: named in the function they would be made again for each match
    def put(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(acc["pieces"], i))
        end = start + F.length(F.get(acc["found"], i))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.get(acc["found"], i).alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"), acc["found"].alias("found"), acc["pieces"].alias("pieces"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"), found.alias("found"), pieces.alias("pieces"))
    placed = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, put, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by kind and start."""
    parts = []
    for kind in KINDS:
        spans = located(text, PATTERNS[kind], kind)
        good = F.filter(spans, _span_test(kind)) if kind != "email" else spans
        possible = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]")
        parts.append(F.when(possible, good).otherwise(F.array().cast(SPAN)))
    return F.concat(*parts)


def _span_test(kind: str):
    return lambda s: _passes(kind, s["value"])


def _entity(span: Column) -> Column:
    """The value in a form that does not depend on case or separators."""
    return F.concat_ws(":", span["kind"], F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(_digits(span["value"])))


def _masked(body: Column, spans: Column) -> Column:
    """body with spaces in place of all spans, so offsets stay."""

    def put(acc: Column, s: Column) -> Column:
        low, high = F.greatest(acc["at"], s["start"]), F.greatest(acc["at"], s["end"])
        return F.struct(high.alias("at"), F.concat(acc["out"], F.substring(body, acc["at"] + 1, low - acc["at"]), F.repeat(F.lit(" "), high - low)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    places = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.aggregate(places, start, put, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))


def _words(text: Column) -> Column:
    """Distinct whole words of two letters or more, as written."""
    return F.filter(F.array_distinct(F.split(text, r"[^\p{L}\p{N}]+")), lambda w: w.rlike(r"^\p{L}{2,}+$"))


def _terms(words: Column) -> Column:
    return F.array_distinct(F.transform(words, F.lower))


def find(docs: DataFrame, text: str = "text", support: int = 3, generalise_at: float = 0.7, remove_at: float = 0.95, dealt: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(rows, terms): rows has doc_id, node (content key) and the base spans of every row;
    terms has node and spans array<struct<start, end, action>> for the texts with disclosed terms."""
    body = text_or_empty(text)
    rows = docs.select("doc_id", content_key(text).alias("node"), base_spans(body).alias("spans"), body.alias("_body"))
    rows = materialize(rows.withColumn("bare", F.when(F.size("spans") > 0, _masked(F.col("_body"), F.col("spans")))).withColumn("odd", F.when(F.size("spans") > 0, F.array_except(_terms(_words(F.col("bare"))), _terms(_words(F.col("_body")))))).drop("_body"))
    holding = rows.filter(F.size("spans") > 0).select("node", F.array_distinct(F.transform("spans", _entity)).alias("entities"), "bare", "odd")
    total = rows.count()
    met = holding.select("entities", F.explode(_terms(_words(F.col("bare")))).alias("term")).select(F.explode("entities").alias("entity"), "term")
    pairs = materialize(met.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_tc")))
    entities = holding.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    every = docs.select(F.explode(_terms(_words(body))).alias("term")).unionAll(holding.select(F.explode("odd").alias("term")))  # odd: whole beside a span only
    counts = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    wanted = materialize(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n_e")).join(counts, "term"))
    common, other = wanted.filter(F.col("n_e") > dealt).drop("n_e"), wanted.filter(F.col("n_e") <= dealt).drop("n_e")
    common = F.broadcast(common)  # at most pairs / dealt rows
    counted = pairs.join(common, "term").unionByName(pairs.join(common, "term", "left_anti").join(other, "term"))
    scored = counted.filter((F.col("n_tc") >= support) | (F.col("n_tc") == F.col("n_t"))).join(entities, "entity")
    share = F.ln(F.lit(float(total)) * F.col("n_tc") / (F.col("n_t") * F.col("n_c"))) / F.ln(F.lit(float(total)) / F.col("n_c"))
    disclosed = scored.filter(F.col("n_c") < total).withColumn("share", share).filter(F.col("share") >= generalise_at)
    action = F.when(F.col("share") >= remove_at, "remove").otherwise("generalise")
    disclosed = disclosed.select("entity", "term", action.alias("action"))
    texts = holding.select("node", "entities", "bare").dropDuplicates(["node"])
    written = texts.select("node", "entities", F.explode(_words(F.col("bare"))).alias("word")).select("node", F.explode("entities").alias("entity"), "word", F.lower("word").alias("term"))
    written = written.join(disclosed, ["entity", "term"]).groupBy("node", "word").agg(F.max("action").alias("action"))
    written = written.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("word", "action"))).alias("actions"))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys("actions"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    placed = texts.join(written, "node").select("node", "actions", located(F.col("bare"), pattern, "term").alias("places"))
    spots = F.transform("places", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at("actions", s["value"]).alias("action")))
    return rows.drop("bare", "odd"), materialize(placed.select("node", spots.alias("terms")))


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs with base spans replaced by [KIND] and disclosed terms by [TERM], or removed."""
    rows, terms = find(docs, text, **options)
    spans = rows.groupBy("node").agg(F.first("spans").alias("_spans")).join(terms.withColumnRenamed("terms", "_terms"), "node", "left").withColumnRenamed("node", "_node")
    spans = spans.filter((F.size("_spans") > 0) | F.col("_terms").isNotNull())
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_body"))
    joined = whole.join(spans, content_key("_body") == F.col("_node"), "left")
    mark = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark")))
    term = F.transform(F.coalesce("_terms", F.array().cast("array<struct<start:int,end:int,action:string>>")), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["action"] == "remove", "").otherwise("[TERM]").alias("mark")))

    def put(acc: Column, s: Column) -> Column:
        later = s["start"] >= acc["at"]
        out = F.when(later, F.concat(acc["out"], F.substring(F.col("_body"), acc["at"] + 1, s["start"] - acc["at"]), s["mark"])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("_body"), acc["at"] + 1, F.length("_body")))
    clean = F.aggregate(F.array_sort(F.concat(mark, term)), start, put, rest)
    row = F.col("_row").withField(text, F.when(F.col("_node").isNull(), F.col("_body")).otherwise(clean))
    return joined.select(row.alias("_row")).select("_row.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, terms = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    line = lambda kind: lambda s: F.concat_ws(":", kind if kind is not None else s["kind"], s["start"], s["end"])
    base = F.transform("spans", line(None))
    extra = F.coalesce(F.transform("terms", line(F.lit("term"))), F.array().cast("array<string>"))
    out = rows.join(terms, "node", "left")
    return out.select("doc_id", *map(n, KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, extra), ",").alias("spans"), F.size(extra).cast("long").alias("n_term"))
