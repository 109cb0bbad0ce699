import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from leafmill.llm import decontaminate, media_store, packing, sharding


def test_ring_rows_law_and_slots(spark, folder_of):
    texts = ["same"] * 50 + [f"text {k}" for k in range(180)] + [None, ""]
    d = folder_of([(k, t, "en") for k, t in enumerate(texts)] + [(5, "same", "en")] * 100)
    rows = sharding.op7(spark, d).collect()
    count = Counter(r["shard"] for r in rows)
    assert len(rows) == len(texts) + 100 and set(count) == set(range(40)) and max(count.values()) - min(count.values()) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        t = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t) + 16, zlib.crc32(t), "rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_ring_moves_little():
    random.seed(1)
    counts = Counter(random.randrange(4096) for _ in range(40_000))

    def owners(shards):
        at = {}
        for s in range(shards):
            r = random.Random(s)
            for _ in range(64):
                at.setdefault(r.randrange(4096), s)
        out, last = [0] * 4096, at[min(at)]
        for p in range(4095, -1, -1):
            last = at.get(p, last)
            out[p] = last
        return out

    def where(shards):
        return {(a, k): s for a, f, t, s, _ in sharding.place(dict(counts), owners(shards), shards) for k in range(f, t)}

    one, two = where(40), where(41)
    assert len(one) == 40_000 and sum(one[k] != two[k] for k in one) / 40_000 < 0.35


def test_limits_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 60, 9)).astype(float)
        counts = rng.integers(1, 9, len(lengths))
        k = int(rng.integers(1, 5))
        cost = lambda limits: sum(c * (min(x for x in limits if x >= n) - n) for n, c in zip(lengths, counts, strict=True))  # noqa: B023, E731
        best = min(cost([*inner, lengths[-1]]) for m in range(min(k, len(lengths))) for inner in combinations(lengths[:-1], m))
        assert cost(packing.best_limits(lengths, counts, k)) == best


def test_batches_fit_the_budget(spark, docs_of):
    docs = docs_of([(k, "w " * (k * 7 % 90), "en") for k in range(300)] + [(900, "x " * 700, "en")] + [(5, "same row", "en")] * 40)
    rows = packing.pack_documents(docs, buckets=5, token_budget=256, cell_rows=8).collect()
    assert len(rows) == 341
    groups = defaultdict(list)
    for r in rows:
        assert r["n_tokens"] <= r["bucket_len"]
        groups[r["bucket"], r["batch"]].append(r)
    for g in groups.values():
        assert sorted(r["place"] for r in g) == list(range(len(g)))
        assert len(g) * g[0]["bucket_len"] <= 256 or len(g) == 1


def test_rounding_grid(spark):
    from pyspark.sql import functions as F

    df = spark.range(1, 200_000, 37).select("id", packing.rounded_up(F.col("id"), 8).alias("r"))
    assert all(r["id"] <= r["r"] <= max(r["id"], r["id"] * (1 + 2 ** -7)) for r in df.collect())


def test_media_round_trip(spark, folder_of):
    texts = ["", None, "é" * 500, "x" * 192, "x" * 193, "x" * 192]
    d = folder_of([(k, t, "en") for k, t in enumerate(texts)])
    rows = {r["doc_id"]: r for r in media_store.op5(spark, d).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (192 * max(1, -(-len(raw) // 192)) - len(raw))
        png = media_store.encode_png(payload)
        r = rows[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(png), hashlib.sha256(png).hexdigest()) and (r["width"], r["height"]) == (192, len(payload) // 192)
        assert media_store.decode_png(png).tobytes() == payload
    with pytest.raises(ValueError):
        media_store.decode_png(png[:40] + b"\0" + png[41:])


def test_shards_are_tar_files(spark, docs_of):
    import tarfile

    index = media_store.store(docs_of([(1, "abc", "en"), (2, "abc", "en"), (3, "d", "en")]))
    shards = {r["shard"] for r in index.collect()}
    names = [m.name for s in shards for m in tarfile.open(s.removeprefix("file://")).getmembers()]
    assert {n.removesuffix(".png") for n in names} == {r["digest"] for r in index.collect()}
    heads = media_store.read_headers(media_store.members(index)).collect()
    assert len(heads) == 2 and all((r["width"], r["bits"]) == (192, 8) for r in heads)


def leaks_brute(docs, items, share=0.5):
    out = set()
    for i, t in docs:
        w = t.split()
        for k, b in items:
            b = b.split()
            for d in range(-len(b) + 1, len(w)):
                n = sum(0 <= d + p < len(w) and w[d + p] == b[p] for p in range(len(b)))
                if n >= share * len(b):
                    out.add((i, k))
    return out


def test_decontamination_tolerates_substitutions(spark, docs_of):
    random.seed(8)
    words = [f"v{k}" for k in range(900)]
    items = [(k, " ".join(random.sample(words, random.choice([5, 6, 7, 8, 14, 30, 59])))) for k in range(30)]
    docs = []
    for i in range(60):
        body = random.sample(words, 200)
        if i < 40:
            b = items[i % 30][1].split()
            if len(b) >= 14:
                for p in random.sample(range(len(b)), len(b) // 8):
                    b[p] = "changed"
            body[50:50] = b
        docs.append((i, " ".join(body)))
    found = decontaminate.find_overlaps(docs_of([(i, t, "en") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    want = leaks_brute(docs, items)
    assert got <= want and len(got) >= 0.97 * len(want)
    kept = decontaminate.drop_leaks(docs_of([(i, t, "en") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in got}
    unbounded = decontaminate.find_overlaps(docs_of([(i, t, "en") for i, t in docs]), spark.createDataFrame(items, "item_id long, text string"), max_seeds=1)
    assert {(r["doc_id"], r["item_id"]) for r in unbounded.collect()} == got


def test_decontamination_finds_parts_of_items(spark, docs_of):
    random.seed(9)
    words = random.sample([f"v{k}" for k in range(9000)], 9000)
    other, i59, i300, i30 = words[:4000], words[4000:4059], words[4100:4400], words[4500:4530]
    items = [(1, " ".join(i59)), (2, " ".join(i300)), (3, " ".join(i30))]
    texts = {
        1: other[:100] + i59[20:45] + other[100:200],  # 25 of 59 words
        2: other[200:300] + i300[120:170] + other[300:400],  # the middle of a long item
        3: i59[-20:] + other[400:500],  # begins inside an item
        4: other[500:600] + i300[:20],  # ends inside an item
        5: other[600:700] + i30[:10] + ["more"] + i30[10:20] + i30[21:] + other[700:800],  # a word more, a word less
        6: other[800:900] + i59[20:30] + other[900:1000],  # 10 of 59 words
        7: other[1000:1100] + i30[:10] + other[1100:1200] + i30[20:] + other[1200:1300],  # two short pieces far apart
    }
    docs = docs_of([(k, " ".join(t), "en") for k, t in texts.items()])
    found = decontaminate.find_overlaps(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["matched"], r["compared"]) for r in found) == [(1, 1, 25, 59), (2, 2, 50, 300), (3, 1, 20, 59), (4, 2, 20, 300), (5, 3, 29, 30)]
