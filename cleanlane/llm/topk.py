"""Exact top-k inner products by an impact-ordered score-at-a-time index.

The index holds the vectors in shards of bounded size.  A shard's postings are
(dimension, vector, impact); its segments are the postings whose impact, in
size, lies in one band, and each vector has the norm of what is still to come
behind every segment.  A search goes over the segments by descending impact
and adds each one's contributions to the scores of all its vectors, for a
block of queries at once.  By Cauchy-Schwarz, a vector's remaining
contribution is at most the query's norm times the vector's remaining norm.
Once few vectors can still be members, judged by these bounds against the
best scores that are already certain, the search stops, and the possible
members are rescored exactly, in whole numbers.  Without that proof it goes
on to the last segment.

Queries are dealt into blocks of bounded size; each goes over the whole index.
Tasks return k rows a query, which one aggregation ranks.

Defined results.  Vectors that are null, or hold a null or non-finite
component, take no part; an empty vector scores 0; components that a shorter
vector lacks count as 0.  A query's own row: all rows with its id.  Equal
scores: the smaller id first, a null id last.  Rows that repeat are candidates
each; repeated query rows (same id and vector) are one query, and rows of one
id with other vectors are queries of their own, under the same id.  Empty
tables give no rows.  Components are floor(scale * x) and must fit into 31
bits; a larger one is an error.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, ship

ship(__name__)

#: Vectors of a shard, queries of a broadcast block, queries that a task scores at once.
SHARD, BLOCK, TILE = 4096, 4096, 256
#: Least impact, in size, of the bands in their order, as shares of the largest impact; the last band has the rest.
BANDS = (0.3, 0.1, 0.04)
#: A search may stop once it has at most so many possible members, in multiples of k and as a mean of its queries.
FEW = 8
NO_ID = np.iinfo(np.int64).max
#: Largest component in size, as a whole number.
MOST = np.iinfo(np.int32).max


def whole_vectors(rows: DataFrame, vec: str, embedding: str, scale: int) -> DataFrame:
    """(vec, x) of the rows that take part; x: components as whole numbers."""
    e = F.col(embedding).cast("array<double>")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(e.isNotNull() & ~bad).select(F.col(vec).cast("long").alias("vec"), F.transform(e, lambda x: F.floor(scale * x)).alias("x"))


def _padded(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _sharder(batches):
    """Rows (n, width, ids, x): shards, their vectors by id."""
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, SHARD):
            part = batch.slice(at, SHARD)
            ids = np.array([NO_ID if i is None else i for i in part.column(0).to_pylist()], np.int64)
            order = np.argsort(ids, kind="stable")
            x = _padded(part.column(1).to_pylist())[order]
            if x.max(initial=0) > MOST or x.min(initial=0) < -MOST:
                raise ValueError(f"a component's floor(scale * x) lies beyond {MOST}")
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([x.shape[1]]), pa.array([ids[order].tobytes()], pa.binary()), pa.array([x.astype(np.int32).tobytes()], pa.binary())], names=["n", "width", "ids", "x"])


def build_index(vectors: DataFrame) -> DataFrame:
    return checkpointed(vectors.mapInArrow(_sharder, "n long, width long, ids binary, x binary"))


def segments(x: np.ndarray):
    """(postings of a band as a matrix, norms of what is behind it), by descending impact."""
    size = np.abs(x)
    top, rest = size.max(initial=0), x
    for share in (*BANDS, 0):
        own = np.where(np.abs(rest) >= share * top, rest, 0)
        rest = rest - own
        yield own, np.sqrt((rest.astype(np.float64) ** 2).sum(1))


def search_shard(x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, floors: np.ndarray):
    """For each query the places of the shard's vectors that may be among its k best.

    ``floors``: a score of each query that k others are known to reach.
    """
    exact = np.abs(x).max(initial=0) * float(np.abs(q).max(initial=0)) * max(x.shape[1], 1) < 2**24
    kind = np.float32 if exact else np.float64
    bands = [(own.T.astype(kind), rest) for own, rest in segments(x)]
    norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    slack = 1 + 1e-9 * norms[:, None] * np.sqrt((x.astype(np.float64) ** 2).sum(1)).max(initial=0)
    first, last = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
    own = [(i, slice(a, b)) for i, (a, b) in enumerate(zip(first, last, strict=True)) if b > a]
    scores = np.zeros((len(q), len(x)), kind)
    q = q.astype(kind)
    for band, (postings, rest) in enumerate(bands):
        scores += q @ postings
        if band == 0:
            continue
        margin = (norms[:, None] * rest[None, :] + slack).astype(np.float64)
        least = scores - margin
        for i, s in own:
            least[i, s] = -np.inf
        floor = floors
        if len(x) > k:
            floor = np.maximum(floors, np.partition(least, len(x) - k, axis=1)[:, len(x) - k])
        possible = scores + margin >= floor[:, None]
        for i, s in own:
            possible[i, s] = False
        if possible.sum() <= FEW * k * len(q):
            break
    return possible


def _searcher(shared, k: int):
    """Rows (q, vec, score): the task's k best of every query."""

    def run(batches):
        import pyarrow as pa

        q, q_ids, q_nrs = shared.value
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q)
        floors = np.full(len(q), -np.inf)
        for batch in batches:
            for n, width, ids, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids, x = np.frombuffer(ids, np.int64), np.frombuffer(raw, np.int32).reshape(n, width).astype(np.int64)
                wide = max(width, q.shape[1])
                x, q = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (x, q))
                for a in range(0, len(q), TILE):
                    possible = search_shard(x, ids, q[a : a + TILE], q_ids[a : a + TILE], k, floors[a : a + TILE])
                    for i in np.flatnonzero(possible.any(1)):
                        at = np.flatnonzero(possible[i])
                        score = np.concatenate([best[a + i][0], x[at] @ q[a + i]])
                        vec = np.concatenate([best[a + i][1], ids[at]])
                        order = np.lexsort((vec, -score))[:k]
                        best[a + i] = score[order], vec[order]
                        if len(order) == k:
                            floors[a + i] = score[order[-1]]
        if len(q):
            sizes = [len(s) for s, _ in best]
            vec = np.concatenate([v for _, v in best])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q_nrs, sizes)), pa.array(vec, mask=vec == NO_ID), pa.array(np.concatenate([s for s, _ in best]))], names=["q", "vec", "score"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 20, vec: str = "vec_id", embedding: str = "embedding", scale: int = 64, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of every query row, by inner product."""
    spark = rows.sparkSession
    index = build_index(whole_vectors(rows, vec, embedding, scale))
    asked = checkpointed(whole_vectors(rows.filter(is_query), vec, embedding, scale).distinct().withColumn("q", F.monotonically_increasing_id()))
    blocks = max(1, math.ceil(asked.count() / block))
    found = None
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).collect()
        ids = np.array([r["vec"] if r["vec"] is not None else NO_ID for r in own], np.int64)
        shared = spark.sparkContext.broadcast((_padded([r["x"] for r in own]), ids, np.array([r["q"] for r in own], np.int64)))
        got = index.mapInArrow(_searcher(shared, k), "q long, vec long, score long")
        found = got if found is None else found.union(got)
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = asked.select("q", F.col("vec").alias("query_id"))
    return ranked.join(names, "q").select("query_id", "rank", F.col("vec").alias("vec_id"), "score")
