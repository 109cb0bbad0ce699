"""Media columns over content-addressed payloads in tar shards.

Payloads are stored as 8-bit greyscale PNG images 192 samples wide, one member of a tar shard for each digest; rows
carry the digest, shard path, offset and length of the stored form. `read_headers` fills metadata columns from range
reads of the first bytes of each member; `read_features` reads whole members back, checks them against the digest
and computes features from the samples.

Shards are files below the folder in spark.checkpoint.dir, written and read with pyarrow's filesystems (so the
executors need no common local disk). A task names its shards with a fresh identifier and the index is written once as
a table, so a task that runs again leaves an unreferenced shard at worst, and no reader sees half a file.
A digest is stored once for each task that meets it, and the index picks one copy: that needs no shuffle of payloads.
Edge cases: a null text is the empty payload, padded to one line of 192 spaces; equal payloads get equal values;
repeated rows stay, null ids and ids beyond 2**53 as they are; very long texts are one member each (a task holds one at a time);
ties (copies of a digest in several shards) go to the least shard and offset; an empty table writes no shard; extra columns, whatever
their names, are not carried (join on the key to get them).
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import materialize, shared_dir, text_or_empty

LINE = 192
HEADER_BYTES = 33  # signature and IHDR chunk
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(raw: bytes) -> bytes:
    """raw with spaces appended up to a positive multiple of LINE."""
    return raw + b" " * (LINE * max(1, -(-len(raw) // LINE)) - len(raw))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes) -> bytes:
    """A greyscale PNG whose samples are the payload's bytes, LINE in a row."""
    lines = np.frombuffer(payload, dtype=np.uint8).reshape(-1, LINE)
    filtered = np.concatenate((np.zeros((len(lines), 1), dtype=np.uint8), lines), axis=1).tobytes()
    head = struct.pack(">IIBBBBB", LINE, len(lines), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(filtered, 6)) + _chunk(b"IEND", b"")


def png_header(raw: bytes) -> tuple[int, int, int, int]:
    """(width, height, bits, colour type) from the first HEADER_BYTES of a PNG."""
    if raw[:8] != _SIGNATURE or raw[12:16] != b"IHDR" or len(raw) < HEADER_BYTES:
        raise ValueError("not a PNG header")
    return struct.unpack(">IIBB", raw[16:26])


def decode_png(raw: bytes) -> np.ndarray:
    """The samples of a PNG written by encode_png; any damage raises."""
    width, height, bits, colour = png_header(raw)
    if (bits, colour) != (8, 0):
        raise ValueError("only 8-bit greyscale is stored")
    at, data = 8, b""
    while at < len(raw):
        (n,), kind = struct.unpack(">I", raw[at : at + 4]), raw[at + 4 : at + 8]
        body = raw[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("chunk checksum differs")
        data += body if kind == b"IDAT" else b""
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("unexpected line filter")
    return lines[:, 1:]


def feature_text(samples: np.ndarray) -> str:
    """Size, mean, deviation and a 64-bit difference hash of 8 x 9 block means."""
    h, w = samples.shape
    rows = np.add.reduceat(samples.astype(np.int64), np.arange(8) * h // 8, axis=0) if h >= 8 else samples.astype(np.int64)[np.arange(8) * h // 8]
    cells = np.add.reduceat(rows, np.arange(9) * w // 9, axis=1)
    bits = (cells[:, :-1] > cells[:, 1:]).ravel()
    mean = int(samples.sum(dtype=np.int64)) * 1000 // samples.size
    spread = int(((samples.astype(np.int64) * 1000 - mean) ** 2).sum()) // samples.size // 1000
    return f"png;{w}x{h};gray8;mean={mean};var={spread};dhash={int(np.packbits(bits).tobytes().hex(), 16):016x}"


class _ShardWriter:
    """Appends members to tar shards of about `shard_bytes`; a shard appears under its name only when complete."""

    def __init__(self, root: str, shard_bytes: int):
        self.fs, self.base = pafs.FileSystem.from_uri(root)
        self.root, self.limit, self.out, self.name, self.at = root, shard_bytes, None, "", 0

    def add(self, digest: str, body: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.at >= self.limit:
            self.close()
        if self.out is None:
            self.name, self.at = f"shard-{uuid.uuid4().hex}.tar", 0
            self.fs.create_dir(self.base, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.base}/{self.name}.part")
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(body)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        offset = self.at + len(head)
        self.out.write(head + body + b"\0" * (-len(body) % tarfile.BLOCKSIZE))
        self.at = offset + len(body) + -len(body) % tarfile.BLOCKSIZE
        return f"{self.root}/{self.name}", offset, len(body)

    def close(self) -> None:
        if self.out is not None:
            self.out.write(b"\0" * (2 * tarfile.BLOCKSIZE))
            self.out.close()
            self.fs.move(f"{self.base}/{self.name}.part", f"{self.base}/{self.name}")
            self.out = None


def store(docs: DataFrame, text: str = "text", shard_bytes: int = 64 << 20) -> DataFrame:
    """Write the padded texts to tar shards; one row for each row of docs: doc_id, n_bytes, digest, shard, offset, length.

    The result is a table in the shared folder: what reads it never writes shards again.
    """
    root = shared_dir(docs.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, known = _ShardWriter(root, shard_bytes), {}
        for part in batches:
            rows = []
            for doc_id, body in zip(part["doc_id"], part["body"], strict=True):
                raw = body.encode("utf-8")
                payload = padded(raw)
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in known:
                    known[digest] = writer.add(digest, encode_png(payload))
                rows.append((doc_id, len(raw), digest, *known[digest]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        writer.close()  # after a failure the task runs again, and the shard keeps its .part name

    kind = docs.schema["doc_id"].dataType.simpleString()
    body = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty(text).alias("body"))  # as text: pandas would make floats of ids beside a null
    written = body.mapInPandas(write, "doc_id string, n_bytes long, digest string, shard string, offset long, length long")
    return materialize(written.withColumn("doc_id", F.col("doc_id").cast(kind)))


def members(index: DataFrame) -> DataFrame:
    """One stored copy of each digest: digest, shard, offset, length."""
    one = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at"))
    return one.select("digest", "at.*")


class _ShardReader:
    """Range reads of members; keeps one shard open at a time."""

    def __init__(self):
        self.systems, self.name, self.src = {}, None, None

    def close(self) -> None:
        if self.src is not None:
            self.src.close()
        self.name = self.src = None

    def read(self, shard: str, offset: int, n: int) -> bytes:
        if shard != self.name:
            self.close()
            root = shard.rpartition("/")[0]
            if root not in self.systems:
                self.systems[root] = pafs.FileSystem.from_uri(root)
            system, base = self.systems[root]
            self.src, self.name = system.open_input_file(f"{base}/{shard.rpartition('/')[2]}"), shard
        return self.src.read_at(n, offset)


def _ranges(batches: Iterator[pd.DataFrame], head: int | None) -> Iterator[Iterator[tuple[str, int, bytes]]]:
    """For each batch, (digest, length, the first `head` bytes of the member, or all of it)."""
    reader = _ShardReader()
    try:
        for part in batches:
            rows = part.sort_values(["shard", "offset"])[["digest", "shard", "offset", "length"]].itertuples(index=False)
            yield ((digest, length, reader.read(shard, offset, min(length, head or length))) for digest, shard, offset, length in rows)
    finally:
        reader.close()


def _spread(found: DataFrame) -> DataFrame:
    """Members dealt by a hash of shard and offset, so that no shard is one task's work."""
    return found.repartition(F.col("shard"), F.floor(F.col("offset") / (4 << 20)))


def read_headers(found: DataFrame) -> DataFrame:
    """digest, width, height, bits, from range reads of HEADER_BYTES of each member."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for members in _ranges(batches, HEADER_BYTES):
            yield pd.DataFrame([(d, *png_header(raw)[:3]) for d, _, raw in members], columns=["digest", "width", "height", "bits"])

    return _spread(found).mapInPandas(read, "digest string, width int, height int, bits int")


def read_features(found: DataFrame) -> DataFrame:
    """digest, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of each member, read back."""
    names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for members in _ranges(batches, None):
            rows = []
            for digest, length, raw in members:
                samples = decode_png(raw)
                payload = samples.tobytes()
                if (sha := hashlib.sha256(payload).hexdigest()) != digest:
                    raise ValueError(f"stored payload differs from its digest: {digest}")
                rows.append((digest, len(payload), sha, zlib.crc32(payload[-16:]), length, hashlib.sha256(raw).hexdigest(), feature_text(samples)))
            yield pd.DataFrame(rows, columns=names)

    return _spread(found).mapInPandas(read, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = store(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = members(index)
    features = read_features(found).join(read_headers(found), "digest")
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height"]
    return index.select("doc_id", "n_bytes", "digest").join(features, "digest").select(*names)
