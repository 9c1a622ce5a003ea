"""Sharding by Karmarkar-Karp differencing of indivisible groups.

Rows with equal texts are a group and stay together.  Groups are dealt into
blocks of bounded size by their hash; in each block the differencing method
combines the two partial partitions with the largest spread, oppositely
ordered, until one k-way partition is left.  The blocks' partitions are
vectors of k sums, which the next level combines by the same method, some
hundreds at a time, until one is left.  So no task ever sees more than one
block, and the driver sees a few counts only.

A group is indivisible: if copies of one text hold more bytes than a fair
share, their shard is larger by as much.

Defined results.  A null text counts as an empty one (size: the overhead
alone).  Repeated rows each get a slot of their own.  An empty table gives no
rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, ship

ship(__name__)

#: Groups that one task combines, and block partitions that one task of a higher level combines.
BLOCK_GROUPS = 4096
FAN_IN = 512
#: Rows that one slot-numbering bucket of a shard holds on average at most, and the least number of buckets.
BUCKET_ROWS = 100_000
LEAST_BUCKETS = 64
OVERHEAD = 16


def karmarkar_karp(vectors: np.ndarray) -> np.ndarray:
    """Of n partial partitions with k sums each, the part that each (item, part) goes to: an n x k array, -1 where a part has no members.

    A part with sum 0 has no members.
    """
    n, k = vectors.shape
    slots = np.arange(n * k).reshape(n, k)
    roots = np.where(vectors > 0, slots, -1)
    parent = np.arange(n * k)
    state = {i: (vectors[i], roots[i]) for i in range(n)}
    heap = [(-int(v.max() - v.min()), i) for i, v in enumerate(vectors)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        (sa, ra), (sb, rb) = state.pop(a), state.pop(b)
        oa, ob = np.argsort(-sa, kind="stable"), np.argsort(sb, kind="stable")
        ra, rb = ra[oa], rb[ob]
        both = (ra >= 0) & (rb >= 0)
        parent[rb[both]] = ra[both]
        sums = sa[oa] + sb[ob]
        state[made] = (sums, np.where(ra >= 0, ra, rb))
        heapq.heappush(heap, (-int(sums.max() - sums.min()), made))
        made += 1
    while not np.array_equal(up := parent[parent], parent):
        parent = up
    part = np.full(n * k, -1)
    if n:
        (_, last) = state[heap[0][1]]
        part[last[last >= 0]] = np.flatnonzero(last >= 0)
    return np.where(vectors > 0, part[parent].reshape(n, k), -1)


def _level_zero(k: int):
    def deal(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        vectors = np.zeros((len(pdf), k), np.int64)
        vectors[:, 0] = pdf["bytes"].to_numpy()
        return pd.DataFrame({"block": pdf["block"].to_numpy(), "key": pdf["key"].to_numpy(), "bytes": pdf["bytes"].to_numpy(), "part": karmarkar_karp(vectors)[:, 0]})

    return deal


def _level_up(k: int):
    def deal(pdf):
        import pandas as pd

        pdf = pdf.sort_values("block", kind="stable")
        vectors = np.stack(pdf["sums"].to_numpy()).astype(np.int64)
        went = karmarkar_karp(vectors)
        return pd.DataFrame({"parent": pdf["parent"].to_numpy(), "block": pdf["block"].to_numpy(), "went": list(went.astype(np.int32))})

    return deal


def shard_groups(groups: DataFrame, shards: int, block_groups: int = BLOCK_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """Shard of each group: ``groups`` has key (distinct) and bytes (over 0); the result key and shard."""
    blocks = max(1, -(-groups.count() // block_groups))
    dealt = groups.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "key", "bytes")
    placed = checkpointed(dealt.groupBy("block").applyInPandas(_level_zero(shards), "block long, key string, bytes long, part int"))
    sums = placed.groupBy("block", "part").agg(F.sum("bytes").alias("bytes"))
    placed = placed.select("block", "key", "part")
    while blocks > 1:
        by_part = F.map_from_entries(F.collect_list(F.struct("part", "bytes")))
        vectors = sums.groupBy("block").agg(by_part.alias("m")).select(F.floor(F.col("block") / fan_in).cast("long").alias("parent"), "block", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0))).alias("sums"))
        went = checkpointed(vectors.groupBy("parent").applyInPandas(_level_up(shards), "parent long, block long, went array<int>"))
        step = went.select("block", "parent", F.posexplode("went").alias("part", "up")).filter("up >= 0")
        sums = sums.join(step, ["block", "part"]).groupBy(F.col("parent").alias("block"), F.col("up").alias("part")).agg(F.sum("bytes").alias("bytes"))
        placed = placed.join(step, ["block", "part"]).select(F.col("parent").alias("block"), "key", F.col("up").alias("part"))
        blocks = -(-blocks // fan_in)
    return placed.select("key", F.col("part").alias("shard"))


def with_slots(rows: DataFrame, n_rows: int, shards: int, by: list[str]) -> DataFrame:
    """``rows`` (shard and the columns ``by``) with ``slot``: gapless from 0 in each shard.

    Equal rows are counted before anything is numbered; buckets of a shard are
    numbered each by itself, behind the counts of the buckets before.
    """
    buckets = max(LEAST_BUCKETS, -(-n_rows // (shards * BUCKET_ROWS)))
    counted = rows.groupBy("shard", *by).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))
    sizes = counted.groupBy("shard", "bucket").agg(F.sum("n").alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, ["shard", "bucket"])
    return numbered.select("shard", *by, F.explode(F.expr("sequence(offset + before, offset + before + n - 1)")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, size, text_crc32, shard and slot of every row; equal texts share a shard."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc).alias("doc"), (F.octet_length(whole) + OVERHEAD).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.sha2(whole, 256).alias("key"))
    rows = checkpointed(rows)
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = shard_groups(groups, shards)
    rows_in = rows.join(placed, "key").select("shard", "doc", "size", "text_crc32")
    out = with_slots(rows_in, rows.count(), shards, ["doc", "size", "text_crc32"])
    return out.select(F.col("doc").alias(doc), "size", "text_crc32", "shard", "slot")
