"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has `points` equal arcs. Each shard owns the arcs that follow its virtual nodes; a key belongs to the arc
its hash falls on. Capacities are tight: row counts of any two shards differ by one at most. Keys take their places
in ring order; a key whose shard is full goes on clockwise to the next virtual node of a shard with room. So balance
is guaranteed, and with one more shard only the keys whose arc changes owner, or that overflow differently, move.

Scale: the driver sees the row count of each arc (`points` numbers, whatever the input) and returns at most
`points` + `points` / arc pieces; these two bounded tables are the only broadcasts. Ranks inside an arc come from
windows over cells of the arc; equal rows are one run with a multiplicity. So neither a group of copies nor a key that
many different rows share (or that is null) is one task's work.
Edge cases: null keys share one place on the ring; a null text has size 16 and the checksum of no bytes; of a very long text only
size and checksum move; repeated rows get a slot each; ties on the ring are broken by a hash of the key columns, then by their order;
an empty table gives no rows; `keys` may have any names (columns called shard or slot give way to the results); others are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import expand_runs, keyed, materialize, ranked_runs, text_or_empty

PIECES = "arc int, piece_from long, piece_to long, shard int, slot_base long"


def ring_owners(spark: SparkSession, shards: int, vnodes: int, points: int) -> list[int]:
    """The shard that owns each arc: the nearest virtual node at or clockwise after it."""
    nodes = spark.range(shards * vnodes).select((F.col("id") % shards).cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit("node"), F.col("id") % shards, F.floor(F.col("id") / shards)), F.lit(points)).cast("int").alias("at"))
    at: dict[int, int] = {}
    for r in nodes.collect():  # shards x vnodes rows
        at[r["at"]] = min(r["shard"], at.get(r["at"], r["shard"]))
    owners, last = [0] * points, at[min(at)]
    for p in range(points - 1, -1, -1):
        last = at.get(p, last)
        owners[p] = last
    return owners


def place(counts: dict[int, int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Fill the shards in ring order: pieces (arc, from, to, shard, slot of the first row), all of bounded number."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    ahead = list(range(1, len(owners) + 1))  # the next arc, past arcs whose shard is full
    ahead[-1] = 0

    def open_arc(p: int) -> int:
        seen = []
        while room[owners[p]] == filled[owners[p]]:
            seen.append(p)
            p = ahead[p]
        for q in seen:
            ahead[q] = p
        return p

    out = []
    for arc in sorted(counts):
        done, p = 0, arc
        while done < counts[arc]:
            p = open_arc(p)
            s = owners[p]
            n = min(counts[arc] - done, room[s] - filled[s])
            out.append((arc, done, done + n, s, filled[s]))
            filled[s] += n
            done += n
    return out


def shard_rows(rows: DataFrame, key: str, keys: list[str], shards: int = 40, vnodes: int = 64, points: int = 16384, cells: int = 64) -> DataFrame:
    """The columns `keys` of each row (key among them) with shard and slot; slots of a shard run from 0 without gaps."""
    spark = rows.sparkSession
    own, names = keyed(rows, keys)
    # an arc is one of `points` slices of the ring
    own = own.withColumn("arc", F.pmod(F.xxhash64(F.lit("key"), F.col(names[keys.index(key)])), F.lit(points)).cast("int"))
    counts = {r["arc"]: r["count"] for r in own.groupBy("arc").count().collect()}  # at most `points` rows
    runs = ranked_runs(own, "arc", names, cells)
    pieces = place(counts, ring_owners(spark, shards, vnodes, points), shards)
    table = F.broadcast(spark.createDataFrame(pieces, PIECES))
    end = F.col("start") + F.col("cnt")
    hit = runs.join(table, "arc").filter((F.col("start") < F.col("piece_to")) & (end > F.col("piece_from")))
    hit = hit.select(*names, "shard", (F.greatest("start", "piece_from") - F.col("piece_from") + F.col("slot_base")).alias("first_slot"), (F.least(end, F.col("piece_to")) - F.greatest("start", "piece_from")).alias("n_slots"))
    out = expand_runs(hit, "first_slot", "n_slots", "slot")
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True) if k not in ("shard", "slot")], "shard", "slot")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = text_or_empty().cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw).cast("long") + 16).alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = shard_rows(materialize(rows), "doc_id", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
