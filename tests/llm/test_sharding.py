import random
import zlib

import numpy as np

from cleanlane.llm import sharding


def test_differencing_beats_greedy_and_keeps_all():
    rng = np.random.default_rng(3)
    for k in (2, 5, 40):
        sizes = rng.integers(1, 10_000, 300)
        vectors = np.zeros((300, k), np.int64)
        vectors[:, 0] = sizes
        part = sharding.karmarkar_karp(vectors)[:, 0]
        sums = np.bincount(part, sizes, k)
        assert part.min() >= 0 and part.max() < k and sums.sum() == sizes.sum()
        greedy = np.zeros(k)
        for s in -np.sort(-sizes):
            greedy[greedy.argmin()] += s
        assert np.ptp(sums) <= np.ptp(greedy)


def test_partial_partitions_are_permuted():
    vectors = np.array([[9, 1, 0], [8, 2, 2], [0, 0, 5]])
    went = sharding.karmarkar_karp(vectors)
    sums = np.zeros(3)
    for v, w in zip(vectors, went, strict=True):
        assert len(set(w[v > 0])) == (v > 0).sum() and (w[v == 0] == -1).all()
        np.add.at(sums, w[v > 0], v[v > 0])
    assert sums.sum() == 27 and np.ptp(sums) <= 4


def test_documents_in_levels(frame, spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 3000) + str(i)) for i in range(600)]
    rows += [(1000 + i, "same") for i in range(200)] + [(5, "same"), (5, "same"), (None, None), (7, ""), (8, "é" * 9)]
    docs = frame([(*r, 1) for r in rows], "doc_id long, text string, SHARD int")
    groups = sharding.F.sha2(sharding.F.coalesce("text", sharding.F.lit("")), 256)
    own = docs.groupBy(groups.alias("key")).agg(sharding.F.sum(sharding.F.octet_length(sharding.F.coalesce("text", sharding.F.lit(""))) + 16).alias("bytes"))
    placed = {r["key"]: (r["shard"], r["bytes"]) for r in sharding.shard_groups(own, 7, block_groups=30, fan_in=3).join(own, "key").collect()}
    sums = np.bincount([s for s, _ in placed.values()], [b for _, b in placed.values()], 7)
    assert len(placed) == own.count() and np.ptp(sums) < 0.01 * sums.mean()
    out = sharding.shard_documents(docs, 7).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out if r["doc_id"] is not None) == sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    for s in range(7):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert len({r["shard"] for r in out if r["text_crc32"] == zlib.crc32(b"same")}) == 1
    assert sharding.shard_documents(docs.limit(0), 7).count() == 0
