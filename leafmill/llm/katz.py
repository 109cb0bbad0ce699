"""Katz backoff language model: counting, discounting, exact normalisation and scoring of whole texts.

Tokens are runs of anything but white space, with A-Z lower-cased, and one end token a text. The model of order n uses
n-grams of tokens (with a begin mark before a text). Counts up to `k` are discounted by Good-Turing from the counts of
counts of all the training rows; an unseen n-gram gets alpha(context) times the probability of the order below,
alpha being (1 - sum of seen probabilities) / (1 - sum of their lower-order probabilities) over all n-grams seen after
that context, so each conditional distribution sums to one. Tokens never seen in training share one unknown token.

Tables. A task reads texts into blocks of about `block_tokens` tokens, kept as files in the shared folder. Each table of the
model (n-gram counts; sums by context) is partitioned by ranges of a 64-bit hash: every block sends each partition its
own distinct keys once, as one packed row, with its counts; the partition adds them up over all blocks and answers
each block with the totals of just its keys. So a token costs a few bytes of shuffle, frequent words are one key a
block and make no partition hot, and no table of the model is ever on the driver or broadcast. For the sums, the first block
that has an n-gram speaks for it: it sends the lower-order probability in whole units of 2**-40 and its class of counts; contexts
go by their numbers in the table of the order below. So a context costs a few bytes, and sums do not depend on the order of blocks. Block by block the
probabilities are then found recursively: the order below first, then the n-gram where it was seen, else alpha times that.

Edge cases: a null text is empty and has the end token only; a context whose n-grams all have high counts keeps
0.5 / (count + 1) for unseen tokens, the rest scaled to sum to one; with no training rows every token is unknown
and has probability one; discounts that the counts of counts do not give (none seen, or not in (0, 1)) are 1 - 0.5 / r;
repeated rows are scored (and counted) each; ties do not arise; an id that is null has no remainder, so its row is not held out and is
learned from; extra columns are not carried, whatever their names. Very long texts are blocks of their own; an empty table gives no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import SPACE_BYTES, crc_mod, materialize, mix64, shared_dir, text_or_empty, word_hashes

END = np.uint64(0x5F0E1D2C3B4A6978)
BEGIN = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_ODD = np.uint64(0x9E3779B97F4A7C15)
REQUEST = "p int, block string, keys binary, v0 binary, v1 binary, v2 binary"
ANSWER = "block string, p int, table int, a0 binary, a1 binary, a2 binary, stats array<long>"
UNIT = 2.0**40  # probabilities of the order below are added up as whole multiples of 1 / UNIT, in any order to the same sum


def pack(x: np.ndarray) -> bytes:
    """Compressed bytes of an array, its byte planes apart."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T if len(x) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, "u8"), dtype=np.uint64)


def discounts(counts_of_counts: list[int], k: int) -> np.ndarray:
    """d[r] for r = 0..k+1 (1 above k) from n_1 .. n_{k+1}."""
    n = [0, *counts_of_counts]
    d = np.ones(k + 2)
    tail = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        value = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        d[r] = value if 0 < value < 1 else 1 - 0.5 / r
    return d


class Model:
    """What the driver knows of the model: totals and the discounts of each order."""

    def __init__(self, k: int):
        self.k, self.tokens, self.types = k, 0, 0
        self.d: dict[int, np.ndarray] = {}

    def learn(self, order: int, stats: np.ndarray) -> None:
        """stats: sum of counts, distinct keys, counts of counts 1 .. k+1."""
        self.d[order] = discounts([int(x) for x in stats[2:]], self.k)
        if order == 1:
            self.tokens, self.types = int(stats[0]), int(stats[1])
            counted = np.arange(1, self.k + 1) * stats[2 : 2 + self.k]
            seen = (self.tokens - float(((1 - self.d[1][1 : self.k + 1]) * counted).sum())) / max(1, self.tokens)
            self.unknown = max(1 - seen, 0.5 / (self.tokens + 0.5 * (self.types + 1))) if self.tokens else 1.0
            self.scale = (1 - self.unknown) / seen if self.tokens else 0.0

    def discounted(self, order: int, c: np.ndarray) -> np.ndarray:
        return self.d[order][np.minimum(c, self.k + 1)] * c


class Block:
    """The tokens of some texts, and what is known of their n-grams so far."""

    def __init__(self, raw: bytes):
        head, *parts = json.loads(raw[8 : 8 + int.from_bytes(raw[:8], "little")])
        at, data = 8 + int.from_bytes(raw[:8], "little"), []
        for n in parts:
            data.append(raw[at : at + n])
            at += n
        self.ids = head
        self.vocab, self.word = unpack_keys(data[0]), unpack(data[1], "u4")
        self.lengths, self.train = unpack(data[2], "i8"), unpack(data[3], "u1").astype(bool)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64)
        self.in_training = np.repeat(self.train, self.lengths)

    @staticmethod
    def build(ids: list, hashes: list[np.ndarray], train: list[bool]) -> bytes:
        vocab, word = np.unique(np.concatenate(hashes), return_inverse=True)
        data = [pack_keys(vocab), pack(word.astype(np.uint32)), pack(np.array([len(h) for h in hashes], dtype=np.int64)), pack(np.array(train, dtype=np.uint8))]
        head = json.dumps([ids, *map(len, data)]).encode()
        return len(head).to_bytes(8, "little") + head + b"".join(data)

    def gram(self, order: int) -> np.ndarray:
        """The hash of the n-gram that ends at each token."""
        words = self.vocab[self.word]
        return words if order == 1 else mix64(self.context(order) * _ODD + words)

    def context(self, order: int) -> np.ndarray:
        """The hash of the order - 1 tokens before each token."""
        out = np.empty(len(self.word), dtype=np.uint64)
        out[1:] = self.gram(order - 1)[:-1]
        out[self.starts] = BEGIN[order]
        return out

    def distinct(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams in order and the place of each token's n-gram among them."""
        return (self.vocab, self.word) if order == 1 else np.unique(self.gram(order), return_inverse=True)

    def contexts(self, place: np.ndarray, n: int) -> np.ndarray:
        """The place of each token's context among the n distinct n-grams of the order below, whose places are given; n is the begin mark."""
        at = np.empty(len(place), dtype=np.int64)
        at[1:] = place[:-1]
        at[self.starts] = n
        return at


def _edges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(partition, from, to) of the keys of each partition that has any."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edge = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(part[a]), a, b


def _pack_matrix(x: np.ndarray) -> bytes:
    return pack(np.ascontiguousarray(x.T).ravel())


def _unpack_matrix(raw: bytes, columns: int) -> np.ndarray:
    return unpack(raw, "i8").reshape(columns, -1).T


def _requests(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["p", "block", "keys", "v0", "v1", "v2"])


def _answers(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["block", "p", "table", "a0", "a1", "a2", "stats"])


def _count_table(requests: DataFrame, table: int, k: int, number: bool) -> DataFrame:
    """A partition of n-gram counts adds up what the blocks sent and answers them with the totals, with whether the block
    is the first that has the n-gram (it speaks for it later) and, with `number`, with the n-grams' numbers in the
    partition; one row has the partition's statistics."""

    def serve(part: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_keys(x) for x in part["keys"]]
        counts = np.concatenate([unpack(x, "i8") for x in part["v0"]])
        unique, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)
        speaks = np.zeros(len(place), dtype=bool)
        speaks[first] = True
        seen = total[total > 0]
        stats = [int(seen.sum()), len(seen), *np.bincount(np.minimum(seen, k + 2), minlength=k + 3)[1 : k + 2].tolist()]
        at = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
        rows = []
        for b, s, e in zip(part["block"], at[:-1], at[1:], strict=True):
            own = place[s:e]
            rows.append((b, int(part["p"].iloc[0]), table, pack(total[own]), pack(speaks[s:e].astype(np.uint8)), pack(np.diff(own, prepend=0).astype(np.uint32)) if number else None, None))
        return _answers([*rows, (None, int(part["p"].iloc[0]), table, None, None, None, stats)])

    return materialize(requests.groupBy("p").applyInPandas(serve, ANSWER))


def _context_table(requests: DataFrame, table: int, k: int) -> DataFrame:
    """A partition of contexts (by their numbers) adds up, and answers to each block, how many n-grams seen after a context
    have count 1 .. k, the counts above k together, and, where the block meets an unseen n-gram after it, the lower-order
    probability (in units) of the seen ones."""

    def serve(part: pd.DataFrame) -> pd.DataFrame:
        own = [np.cumsum(unpack(x, "u4"), dtype=np.int64) for x in part["keys"]]
        place = np.concatenate(own)
        add = lambda v: np.bincount(place, weights=v).astype(np.int64)  # noqa: E731  whole numbers below 2**53
        lower = add(np.concatenate([unpack(x, "i8") for x in part["v0"]]))
        sent = np.concatenate([_unpack_matrix(x, k + 1) for x in part["v1"]])
        kinds = np.stack([add(sent[:, r]) for r in range(k + 1)], axis=1)
        asks = [unpack(x, "u1") > 0 for x in part["v2"]]
        return _answers([(b, int(part["p"].iloc[0]), table, pack(lower[x[m]]), _pack_matrix(kinds[x]), None, None) for b, x, m in zip(part["block"], own, asks, strict=True)])

    return requests.groupBy("p").applyInPandas(serve, ANSWER)


def _weights(lower: np.ndarray, kinds: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(alpha, the factor of seen probabilities, the count) of contexts."""
    k = kinds.shape[1] - 1
    r = np.arange(1, k + 1)
    count = kinds[:, :k] @ r + kinds[:, k]
    seen = (kinds[:, :k] @ (r * d[1 : k + 1]) + kinds[:, k]) / np.maximum(count, 1)
    left = np.maximum(1 - seen, 0.5 / (count + 1))
    alpha = np.where(count > 0, left / np.maximum(1 - lower / UNIT, 1e-300), 1.0)
    factor = np.where((count > 0) & (left > 1 - seen), (1 - left) / np.where(seen > 0, seen, 1), 1.0)
    return alpha, factor, count


def _read(root: str, block: str) -> Block:
    system, base = pafs.FileSystem.from_uri(root)
    with system.open_input_file(f"{base}/{block}") as f:
        return Block(f.read())


def _table(answers: pd.DataFrame, table: int, column: str, read: Callable[[bytes], np.ndarray]) -> np.ndarray:
    """The answers of all partitions to one block, in the order of its keys (the begin mark last)."""
    own = answers[answers["table"] == table].sort_values("p")
    return np.concatenate([read(x) for x in own[column]])


def _longs(raw: bytes) -> np.ndarray:
    return unpack(raw, "i8")


def _unigrams(b: Block, model: Model, c: np.ndarray) -> np.ndarray:
    p = np.full(len(c), model.unknown)
    known = c > 0
    p[known] = model.discounted(1, c[known]) / model.tokens * model.scale
    return p[b.word]


def _probabilities(b: Block, model: Model, answers: pd.DataFrame, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The probability of each token given the order - 1 before it, recursively from that of the order below; and
    `distinct(order)` of the block, which the order above needs."""
    if order == 1:
        return _unigrams(b, model, _table(answers, 2, "a0", _longs)), *b.distinct(1)
    below, keys, place = _probabilities(b, model, answers, order - 1)
    at = b.contexts(place, len(keys))
    n = len(keys) + 1
    keys, place = b.distinct(order)
    c = _table(answers, 2 * order, "a0", _longs)[place]
    lower = np.zeros(n, dtype=np.int64)
    lower[_backing_off(at, c, n)] = _table(answers, 2 * order + 1, "a0", _longs)
    kinds = _table(answers, 2 * order + 1, "a1", lambda x: _unpack_matrix(x, model.k + 1))
    alpha, factor, count = _weights(lower, kinds, model.d[order])
    return np.where(c > 0, model.discounted(order, c) * factor[at] / np.maximum(count[at], 1), alpha[at] * below), keys, place


def _backing_off(at: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """Which of n contexts an unseen n-gram (count 0) follows; at: the context of each token."""
    out = np.zeros(n, dtype=bool)
    out[at[c == 0]] = True
    return out


def score(docs: DataFrame, train: Column, text: str = "text", order: int = 3, k: int = 5, block_tokens: int = 2_500_000, partition_tokens: int = 1_500_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row; learns where `train` is true."""
    root = shared_dir(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), text_or_empty(text).alias("body"))

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = pafs.FileSystem.from_uri(root)
        system.create_dir(base, recursive=True)
        ids, hashes, training, n = [], [], [], 0

        def flush() -> pd.DataFrame:
            name = uuid.uuid4().hex
            raw = Block.build(ids, hashes, training)
            with system.open_output_stream(f"{base}/{name}") as f:
                f.write(raw)
            return pd.DataFrame({"block": [name], "tokens": [n]})

        for part in batches:
            for doc_id, to_train, body in zip(part["doc_id"], part["train"], part["body"], strict=True):
                h = np.append(word_hashes(body.encode("utf-8").lower(), SPACE_BYTES)[0], END)
                ids.append(doc_id)
                hashes.append(h)
                training.append(bool(to_train))
                n += len(h)
                if n >= block_tokens:
                    yield flush()
                    ids, hashes, training, n = [], [], [], 0
        if ids:
            yield flush()

    blocks = materialize(rows.mapInPandas(tokenise, "block string, tokens long"))
    total, number = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count(F.lit(1))).first()
    # a row that names a block, or answers one, stands for millions of tokens, so these tasks are dealt by number, not by bytes
    dealt = max(1, min(number, 100_000))
    bits = max(5, min(24, int(total // partition_tokens).bit_length()))
    model = Model(k)
    cut = blocks.select("block").repartition(dealt, "block")

    def learned(answers: DataFrame, level: int) -> DataFrame:
        sums = [F.sum(F.get("stats", i)).alias(f"s{i}") for i in range(k + 3)]
        model.learn(level, np.array([x or 0 for x in answers.filter(F.col("block").isNull()).agg(*sums).first()]))
        return answers.filter(F.col("block").isNotNull())

    def each(answers: DataFrame, work: Callable[[str, Block, pd.DataFrame], pd.DataFrame], schema: str, level: int = 0) -> DataFrame:
        """work on each block and the answers to it: those that the sums of `level` need, or the probabilities alone."""
        table = F.col("table")
        slim = answers.withColumns({"a1": F.when((table % 2 == 1) | (table == 2 * level), F.col("a1")), "a2": F.when(table == 2 * (level - 1), F.col("a2"))})
        return slim.repartition(dealt, "block").groupBy("block").applyInPandas(lambda part: work(part["block"].iloc[0], _read(root, part["block"].iloc[0]), part), schema)

    def counted(level: int) -> DataFrame:
        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                for name in part["block"]:
                    b = _read(root, name)
                    keys, place = b.distinct(level)
                    counts = np.bincount(place[b.in_training], minlength=len(keys))  # in training texts
                    yield _requests([(p, name, pack_keys(keys[s:e]), pack(counts[s:e]), None, None) for p, s, e in _edges(keys, bits)])

        return learned(_count_table(cut.mapInPandas(count, REQUEST), 2 * level, k, level < order), level)

    answers = counted(1)
    for level in range(2, order + 1):

        def sums(name: str, b: Block, known: pd.DataFrame, level: int = level) -> pd.DataFrame:
            below, shorter, place = _probabilities(b, model, known, level - 1)
            n = len(shorter) + 1  # contexts, the begin mark among them
            at = b.contexts(place, len(shorter))
            keys, place = b.distinct(level)
            total = _table(known, 2 * level, "a0", _longs)
            asks = _backing_off(at, total[place], n).astype(np.uint8)
            where = np.zeros(len(keys), dtype=np.int64)
            where[place] = np.arange(len(place))  # some token that ends each n-gram
            del keys, place
            mine = (_table(known, 2 * level, "a1", lambda x: unpack(x, "u1")) > 0) & (total > 0)
            total, where = total[mine], where[mine]
            at = at[where]
            lower = np.bincount(at, weights=np.rint(below[where] * UNIT), minlength=n).astype(np.int64)
            kinds = np.empty((n, k + 1), dtype=np.int64)
            for r in range(1, k + 1):
                kinds[:, r - 1] = np.bincount(at[total == r], minlength=n)
            more = total > k
            kinds[:, k] = np.bincount(at[more], weights=total[more], minlength=n)
            own = known[known["table"] == 2 * (level - 1)].sort_values("p")
            rows = [(p, name, x, pack(lower[s:e]), _pack_matrix(kinds[s:e]), pack(asks[s:e])) for (p, s, e), x in zip(_edges(shorter, bits), own["a2"], strict=True)]
            return _requests([*rows, (1 << bits, name, pack(np.zeros(1, dtype=np.uint32)), pack(lower[-1:]), _pack_matrix(kinds[-1:]), pack(asks[-1:]))])

        answers = answers.unionByName(counted(level))
        answers = answers.unionByName(materialize(_context_table(each(answers, sums, REQUEST, level), 2 * level + 1, k)))

    def final(_: str, b: Block, known: pd.DataFrame) -> pd.DataFrame:
        p, _, _ = _probabilities(b, model, known, order)
        c = _table(known, 2, "a0", _longs)
        base = np.log10((c + 0.5) / (model.tokens + 0.5 * (model.types + 1)))[b.word]
        sum_up = lambda x: np.add.reduceat(x, b.starts)
        return pd.DataFrame({"doc_id": b.ids, "held_out": ~b.train, "n_tokens": b.lengths, "n_known": sum_up((c > 0)[b.word].astype(np.int64)), "train_tokens": model.tokens, "base_score": sum_up(base), "score": sum_up(np.log10(p))})

    out = each(answers, final, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, F.coalesce(crc_mod("doc_id", 5) != 1, F.lit(True)))
