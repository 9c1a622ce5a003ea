"""Exact k-nearest neighbours inside one point set, without all-pairs joins.

Used by SMOTE (M3).  Points are first de-duplicated (a vector repeated a
million times becomes one point with a multiplicity), then dealt to cells of a
k-d tree whose cuts come from a bounded sample (``SAMPLE_ROWS``):

1. each cell finds the k nearest neighbours of its points among the cell
   (grouped ``applyInArrow``, NumPy inside the task), giving a radius r(x), and
   the box that its points fill (one row per cell is collected);
2. a point visits the other cells whose box lies within its radius, no others:
   every neighbour nearer than r(x) is in one of them;
3. a visited cell returns what it has within r(x), and the lists of a point are
   merged to the k smallest distances.

A cell holds about ``rows_per_bucket`` points, and its visitors come in slices of
at most ``VISITORS``, so no task holds more than one cell and one slice.  Ties
are settled by point id, whatever the order of the rows.  Points with a missing or infinite component have no
neighbours and are nobody's.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The grouped functions below run in Python workers; ship this module's code with
# the task (by value) so executors need no installed copy of the package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be on the executors' path
    pass

NEIGHBOURS_SCHEMA = "pid long, vec array<double>, mult long, nn_vecs array<array<double>>"
NEAR = "array<struct<d2: double, pid: long, vec: array<double>>>"

#: Points that the cuts of the tree are taken from, at most.
SAMPLE_ROWS = 100_000
#: Points of other cells that one task compares with a cell, at most.
VISITORS = 20_000


def _tree(sample: np.ndarray, per_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts of ``sample`` at medians of the widest dimension, down to ``per_leaf`` points: (dimension or -1 - leaf, cut, left, right)."""
    nodes, todo, leaves = [], [(None, 0, np.arange(len(sample)))], 0
    while todo:
        parent, side, rows = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][side] = me
        x = sample[rows]
        dim = int(np.argmax(x.var(axis=0))) if len(rows) else 0
        v = x[:, dim] if len(rows) else np.zeros(0)
        if len(rows) <= per_leaf or v.min() == v.max():
            nodes.append([-1 - leaves, 0.0, -1, -1])
            leaves += 1
            continue
        cut = float(np.median(v))
        if not (v < cut).any():  # most points have the smallest value: they are the left side
            cut = float(v[v > cut].min())
        nodes.append([dim, cut, -1, -1])
        todo += [(me, 3, rows[v >= cut]), (me, 2, rows[v < cut])]
    return tuple(np.array(c) for c in zip(*nodes, strict=True))


def _leaf_of(tree, x: np.ndarray) -> np.ndarray:
    dim, cut, left, right = tree
    at = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(dim[at] >= 0)
        if not len(inner):
            return -1 - dim[at]
        n = at[inner]
        at[inner] = np.where(x[inner, dim[n]] < cut[n], left[n], right[n])


def _matrix(column, dim: int) -> np.ndarray:
    """The rows of a column of arrays of ``dim`` doubles; missing components are NaN."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _lists(values, counts: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _nearest(H: np.ndarray, h_pid: np.ndarray, C: np.ndarray, c_pid: np.ndarray, c_mult: np.ndarray, k: int, limit2: np.ndarray, block: int = 512):
    """For each row of H: its k nearest rows of C no farther than the root of ``limit2``, nearest first.

    A row of C counts min(mult, k) times, one time less for itself (the same id), so a
    point's other copies are neighbours at distance 0.  Returns the squared k-th
    distances (infinite with fewer than k) and (d2, rows of C, entries per row).
    """
    order = np.argsort(c_pid, kind="stable")
    C, pid, mult = C[order], c_pid[order], np.minimum(c_mult[order], k + 1)
    mid = C.mean(axis=0)
    C0 = C - mid
    cn = (C0 * C0).sum(axis=1)
    kth, found_d, found_c, counts = np.full(len(H), np.inf), [], [], np.zeros(len(H), np.int64)
    take = min(k + 4, len(C))
    for s in range(0, len(H), block):
        ids, H0 = h_pid[s : s + block], H[s : s + block] - mid
        near = cn[None, :] - 2.0 * (H0 @ C0.T)
        at = np.argpartition(near, take - 1, axis=1)[:, :take] if take < len(C) else np.tile(np.arange(len(C)), (len(H0), 1))
        # the products round: the distances of those taken come from the differences
        d2 = ((C[at] - H[s : s + block, None, :]) ** 2).sum(axis=2)
        o = np.lexsort((at, d2), axis=1)
        at, d2 = np.take_along_axis(at, o, 1), np.take_along_axis(d2, o, 1)
        copies = mult[at] - (pid[at] == ids[:, None])
        copies[~(d2 <= limit2[s : s + block, None])] = 0
        room = np.clip(k - (np.cumsum(copies, axis=1) - copies), 0, copies)
        n = room.sum(axis=1)
        flat = np.repeat(np.arange(room.size), room.ravel())
        d, c = d2.ravel()[flat], at.ravel()[flat]
        found_d.append(d)
        found_c.append(order[c])
        counts[s : s + block] = n
        ends = np.cumsum(n)
        kth[s : s + block] = np.where(n >= k, d[np.maximum(ends - 1, 0)] if len(d) else np.inf, np.inf)
    return kth, np.concatenate(found_d) if found_d else np.zeros(0), np.concatenate(found_c) if found_c else np.zeros(0, np.int64), counts


def _near_column(C: np.ndarray, c_pid: np.ndarray, d2: np.ndarray, at: np.ndarray, counts: np.ndarray):
    import pyarrow as pa

    vecs = _lists(pa.array(C[at].ravel()), np.full(len(at), C.shape[1]))
    return _lists(pa.StructArray.from_arrays([pa.array(d2), pa.array(c_pid[at], pa.int64()), vecs], names=["d2", "pid", "vec"]), counts)


def knn_within(points: DataFrame, vec_col: str, k: int = 5, seed: int = 42, rows_per_bucket: int = 4000, dim: int | None = None) -> DataFrame:
    """Exact kNN of every distinct vector of ``points`` among the same set.

    Returns (pid, vec, mult, nn_vecs): one row per distinct vector with its
    multiplicity and the vectors of its k nearest neighbours (fewer if the
    set has fewer than k+1 points).  The result is persisted (MEMORY_AND_DISK);
    call ``unpersist()`` on it when done.
    """
    import pyarrow as pa

    spark = points.sparkSession
    distinct = points.groupBy(F.col(vec_col).cast("array<double>").alias("vec")).agg(F.count(F.lit(1)).alias("mult"))
    if dim is None:
        dim_row = distinct.select(F.size("vec").alias("d")).first()
        if dim_row is None:
            return spark.createDataFrame([], NEIGHBOURS_SCHEMA)
        dim = int(dim_row["d"])
    # the distinct points feed the jobs below: keep them (MEMORY_AND_DISK; lost blocks recompute from lineage)
    kept = distinct.withColumn("pid", F.xxhash64(F.lit(seed), "vec")).persist(StorageLevel.MEMORY_AND_DISK)
    finite = F.forall("vec", lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    pts, lone = kept.where(finite), kept.where(~finite)
    n = pts.count()
    n_b = max(1, math.ceil(n / rows_per_bucket))
    tree = _tree(np.zeros((0, dim)), 1)
    if n_b > 1:
        every = max(1, math.ceil(n / SAMPLE_ROWS))
        rows = pts.where(F.pmod(F.xxhash64(F.lit(seed + 7), "pid"), F.lit(every)) == 0).select("vec").toArrow()
        sample = _matrix(rows["vec"], dim)
        tree = _tree(sample, max(1, len(sample) // n_b))

    def deal(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            yield from t.append_column("leaf", pa.array(_leaf_of(tree, _matrix(t["vec"], dim)), pa.int32())).to_batches()

    dealt = pts.select("pid", "vec", "mult").mapInArrow(deal, "pid long, vec array<double>, mult long, leaf int")

    def inside(t: pa.Table) -> pa.Table:
        x, pid = _matrix(t["vec"], dim), t["pid"].to_numpy()
        kth, d2, at, counts = _nearest(x, pid, x, pid, t["mult"].to_numpy(), k, np.full(len(x), np.inf))
        box = [pa.array([x.min(axis=0).tolist(), *[None] * (len(x) - 1)], pa.list_(pa.float64())), pa.array([x.max(axis=0).tolist(), *[None] * (len(x) - 1)], pa.list_(pa.float64()))]
        return pa.table([t["pid"], t["vec"], t["mult"], t["leaf"], pa.array(kth), _near_column(x, pid, d2, at, counts), *box], names=["pid", "vec", "mult", "leaf", "kth", "near", "lo", "hi"])

    first = dealt.groupBy("leaf").applyInArrow(inside, f"pid long, vec array<double>, mult long, leaf int, kth double, near {NEAR}, lo array<double>, hi array<double>").persist(StorageLevel.MEMORY_AND_DISK)
    boxes = first.where(F.col("lo").isNotNull()).select("leaf", "lo", "hi").toArrow()
    near = first.select("pid", "vec", "mult", "near")
    trips = None
    if boxes.num_rows > 1:
        leaf_ids, lo, hi = boxes["leaf"].to_numpy(), _matrix(boxes["lo"], dim), _matrix(boxes["hi"], dim)
        shared = spark.sparkContext.broadcast((leaf_ids, lo, hi))

        def visits(batches):
            ids, lo, hi = shared.value
            for b in batches:
                t = pa.Table.from_batches([b])
                x, kth, leaf = _matrix(t["vec"], dim), t["kth"].to_numpy(), t["leaf"].to_numpy()
                for own in np.unique(leaf):
                    rows = np.flatnonzero(leaf == own)
                    some, most = x[rows], kth[rows].max()
                    gap = np.maximum(0.0, np.maximum(lo - some.max(axis=0), some.min(axis=0) - hi))
                    # a little more than the radius: sums of squares round
                    for j in np.flatnonzero((gap * gap).sum(axis=1) <= most * (1 + 1e-9)):
                        if ids[j] != own:
                            gap_of = np.maximum(0.0, np.maximum(lo[j] - some, some - hi[j]))
                            go = rows[(gap_of * gap_of).sum(axis=1) <= kth[rows] * (1 + 1e-9)]
                            if len(go):
                                yield from t.take(pa.array(go)).select(["pid", "vec", "kth"]).append_column("leaf", pa.array(np.full(len(go), ids[j]), pa.int32())).to_batches()

        trips = first.select("pid", "vec", "kth", "leaf").mapInArrow(visits, "pid long, vec array<double>, kth double, leaf int").persist(StorageLevel.MEMORY_AND_DISK)
        slices = trips.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(VISITORS)).cast("int").alias("parts"))
        # one row per cell: a bounded broadcast
        slices = F.broadcast(slices)
        part = F.pmod(F.xxhash64(F.lit(seed + 8), "pid"), F.col("parts")).cast("int")
        guests = trips.join(slices, "leaf").select("leaf", part.alias("part"), "pid", "vec", "kth")
        homes = dealt.join(slices, "leaf").select("leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "pid", "vec", "mult")

        def meet(own: pa.Table, guest: pa.Table) -> pa.Table:
            if not own.num_rows or not guest.num_rows:
                return pa.table([pa.array([], pa.int64()), _near_column(np.zeros((0, dim)), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))], names=["pid", "more"])
            c, c_pid = _matrix(own["vec"], dim), own["pid"].to_numpy()
            _, d2, at, counts = _nearest(_matrix(guest["vec"], dim), guest["pid"].to_numpy(), c, c_pid, own["mult"].to_numpy(), k, guest["kth"].to_numpy() * (1 + 1e-9))
            table = pa.table([guest["pid"], _near_column(c, c_pid, d2, at, counts)], names=["pid", "more"])
            return table.filter(pa.array(counts > 0))

        met = homes.groupBy("leaf", "part").cogroup(guests.groupBy("leaf", "part")).applyInArrow(meet, f"pid long, more {NEAR}")
        more = met.groupBy("pid").agg(F.flatten(F.collect_list("more")).alias("more"))
        both = F.slice(F.sort_array(F.concat("near", "more")), 1, k)
        near = near.join(more, "pid", "left").select("pid", "vec", "mult", F.when(F.col("more").isNull(), F.col("near")).otherwise(both).alias("near"))
    out = near.select("pid", "vec", "mult", F.transform("near", lambda e: e["vec"]).alias("nn_vecs"))
    out = out.unionByName(lone.select("pid", "vec", "mult", F.array().cast("array<array<double>>").alias("nn_vecs")))
    # materialised once; the caller reads it several times and unpersists it
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    for d in (kept, first, trips):
        if d is not None:
            d.unpersist()
    return out


def brute_force_knn(vectors: np.ndarray, k: int) -> list[list[int]]:
    """Reference O(n^2) neighbours for tests: indices of the k nearest (excluding self)."""
    d2 = ((vectors[:, None, :] - vectors[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    return [list(np.argsort(row, kind="stable")[:k]) for row in d2]


VECTOR = T.ArrayType(T.DoubleType())
