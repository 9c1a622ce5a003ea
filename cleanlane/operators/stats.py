"""Distributed exact order statistics and ordered running totals.

Spark's exact ``percentile`` aggregate buffers a value->count map per group and
merges it in a single task, which does not hold for continuous columns with
billions of distinct values.  ``quantiles`` reaches the same exact,
linearly-interpolated answer (pandas / NumPy ``linear`` / DuckDB
``quantile_cont``) in bounded passes:

1. a mergeable Greenwald-Khanna sketch (``approx_percentile``, map-side partial
   aggregation) per group brackets every wanted rank within +-2n/accuracy rows,
   or wider where that would be less than the four rows that rounding needs;
2. without groups, a second scan narrows the brackets of all columns by sketches
   of what lies inside (``_quantiles_wide``);
3. one grouped count of the values inside the bracket, plus a single "below"
   counter per target, pins the exact order statistics.  The counting is
   pre-aggregated before the shuffle, so a hot group costs no more than a
   cold one; the per-target window only sees the bracket's distinct values.

A bracket that missed its rank (which the sketch's error bound rules out) is moved
and counted again; in a grouped call it raises instead of returning a wrong value.

``running_totals`` gives cumulative sums in a global order without a
single-partition window: rows are range-bucketed by sketch cut points, bucket
totals are prefixed (one row per bucket), and the running sum inside each
bucket is a window partitioned by bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sketch accuracy for the bracketing pass: rank error <= n / accuracy.
DEFAULT_ACCURACY = 10_000


# Points of the sketch inside a bracket: each further scan narrows a bracket about GRID times.
GRID = 128
# Rows strictly between the ends of a bracket that are counted by value without narrowing it again.
MAX_CANDIDATES = 1_000_000


def _margins(accuracy: int) -> list[float]:
    """Half widths of brackets, as shares of the rows, from twice the sketch's error up to everything."""
    out = [2.0 / accuracy]
    while out[-1] < 1:
        out.append(out[-1] * 10)
    return out


def _constant(numbers: Sequence[float]) -> Column:
    """The numbers as one small constant expression: plans of many columns repeat it for each of them."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")


def _bracket_probs(probs: Sequence[float], accuracy: int) -> list[float]:
    """For each position and each margin, the positions of the bracket's two ends."""
    return [min(1.0, max(0.0, p + s * m)) for p in probs for m in _margins(accuracy) for s in (-1, 1)]


def _margin_ends(n: int, j: int, accuracy: int) -> tuple[int, int]:
    """Places, in the answer to ``_bracket_probs``, of the ends of position ``j`` among ``n`` rows.

    The least margin that covers the sketch's error and four rows: the sketch
    ranks by ceil(p * n), interpolation by (n - 1) * p, and sizes round.
    """
    ms = _margins(accuracy)
    level = next((i for i, m in enumerate(ms) if m >= 1.0 / accuracy + 4.0 / n), len(ms) - 1)
    return 2 * (j * len(ms) + level), 2 * (j * len(ms) + level) + 1


@dataclass
class _Target:
    """One wanted quantile: ranks ``k`` and ``k2`` (0-based) of a column's ``n`` values, and its bracket."""

    column: str
    prob: float
    n: int
    k: int
    k2: int
    frac: float
    lo: float
    hi: float
    state: str = "wide"
    outer: tuple[float, float] = (-math.inf, math.inf)
    v1: float = math.nan
    v2: float = math.nan

    def missed(self, below: int, upto_hi: int) -> bool:
        """Move the bracket to the side its ranks lie on, if it does not hold them."""
        if below <= self.k and self.k2 < upto_hi:
            return False
        self.lo, self.hi = self.lo if self.k >= below else self.outer[0], self.hi if self.k2 < upto_hi else self.outer[1]
        self.outer, self.state = (-math.inf, math.inf), "wide"
        return True

    def solve(self, v1: float, v2: float) -> None:
        self.v1, self.v2, self.state = v1, v2, "solved"


def gram(df: DataFrame, columns: Sequence) -> np.ndarray:
    """Sums of all products of two columns (none may be null), as a matrix.

    A distributed row matrix adds up each row's products in tasks, in one packed
    array a task, and adds these up as a tree; the plan has one vector column
    whatever the number of columns.
    """
    k = len(columns)
    rows = df.select(array_to_vector(F.array(*columns)).alias("v"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), 0, k).computeGramianMatrix().toArray()


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value double) per non-null, non-NaN cell of ``cols``."""
    by = list(by)
    if len(cols) == 1:
        c = cols[0]
        out = df.select(*by, F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
    else:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
        out = df.select(*by, F.inline(cells))
    return out.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _brackets(values: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """(keys..., n, lo array, hi array): value brackets around rank ~p*n for each position p.

    The margin is the least that covers the sketch's error and four rows of the group
    (see ``_margin_ends``; the same law at every size).
    """
    sketch = values.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.approx_percentile("value", _constant(_bracket_probs(probs, accuracy)), accuracy).alias("br"),
    )
    ms = _margins(accuracy)
    level = F.lit(len(ms) - 1)
    for i in range(len(ms) - 2, -1, -1):
        level = F.when(F.lit(ms[i]) >= F.lit(1.0 / accuracy) + F.lit(4.0) / F.col("n"), i).otherwise(level)
    ends = [[F.get("br", 2 * (F.lit(j * len(ms)) + F.col("level")) + side) for j in range(len(probs))] for side in (0, 1)]
    return sketch.withColumn("level", level).select(*keys, "n", F.array(*ends[0]).alias("lo"), F.array(*ends[1]).alias("hi"))


#: Parts in which the values of one group meet that group's row.
GROUP_SALTS = 64


def met_in_parts(values: DataFrame, per_group: DataFrame, keys: list[str]) -> DataFrame:
    """Each distinct ``value`` of a group, with its number of ``copies``, beside the group's row.

    Copies are merged first (map-side, then spread by value) and the values of a
    group meet its row in ``GROUP_SALTS`` parts, so neither a hot value nor a hot
    group is one task's.
    """
    counted = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(GROUP_SALTS)).cast("int"))
    rows = per_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(GROUP_SALTS - 1))))
    return counted.join(rows, [*keys, "salt"]).drop("salt")


def _resolve(values: DataFrame, targets: DataFrame, keys: list[str], n_pos: int, broadcast_targets: bool) -> DataFrame:
    """Exact order statistics inside the brackets.

    ``targets``: one row per group (keys...) with arrays ``lo``, ``hi`` and
    0-based ranks ``k``, ``k2`` (each of length ``n_pos``).  One narrow
    aggregate over the values (key: group + candidate value, where the
    candidate is null outside every bracket) yields, per position, the count
    of values below its bracket and the counts of the distinct in-bracket
    values; everything after it handles candidates only.
    Returns (keys..., pos, v1, v2, bad): the values at ranks k and k2.
    """
    ends = targets.select(*keys, "lo", "hi")
    if broadcast_targets:
        met = values.withColumn("copies", F.lit(1)).join(F.broadcast(ends), keys)
    else:
        met = met_in_parts(values, ends, keys)
    v = F.col("value")
    inside = [(v >= F.col("lo")[i]) & (v <= F.col("hi")[i]) for i in range(n_pos)]
    any_inside = inside[0]
    for c in inside[1:]:
        any_inside = any_inside | c
    agg = (
        met.groupBy(*keys, F.when(any_inside, v).alias("cv"))
        .agg(F.sum("copies").alias("cnt"), *[F.sum(F.when(v < F.col("lo")[i], F.col("copies")).otherwise(0)).alias(f"b{i}") for i in range(n_pos)])
    )
    below = agg.groupBy(*keys).agg(F.array(*[F.sum(f"b{i}") for i in range(n_pos)]).alias("below"))
    cands = agg.where(F.col("cv").isNotNull()).select(*keys, "cv", "cnt")
    per_pos = (
        targets.join(below, keys)
        .select(*keys, F.posexplode(F.arrays_zip("lo", "hi", "k", "k2", "below")).alias("pos", "t"))
        .select(*keys, "pos", "t.lo", "t.hi", "t.k", "t.k2", "t.below")
    )
    c = cands.join(per_pos, keys).where((F.col("cv") >= F.col("lo")) & (F.col("cv") <= F.col("hi")))
    w = Window.partitionBy(*keys, "pos").orderBy("cv").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = c.withColumn("cum", F.col("below") + F.sum("cnt").over(w))
    res = c.groupBy(*keys, "pos", "k", "k2", "below").agg(
        F.max("cum").alias("upto_hi"),
        F.min(F.when(F.col("cum") > F.col("k"), F.col("cv"))).alias("v1"),
        F.min(F.when(F.col("cum") > F.col("k2"), F.col("cv"))).alias("v2"),
    )
    # a position with no candidate at all also missed its bracket
    res = per_pos.join(res.drop("k", "k2", "below"), keys + ["pos"], "left")
    bad = F.col("upto_hi").isNull() | (F.col("below") > F.col("k")) | (F.col("upto_hi") <= F.col("k2"))
    return res.select(*keys, "pos", "v1", "v2", bad.alias("bad"))


LOCAL_TARGET_ROWS = 100_000


def _materialise(targets: DataFrame) -> DataFrame:
    """Compute the per-group target table once (it is read three times downstream).

    Up to LOCAL_TARGET_ROWS rows it becomes a local relation (collected: the
    size was just counted); beyond that it stays persisted MEMORY_AND_DISK.
    """
    targets = targets.persist(StorageLevel.MEMORY_AND_DISK)
    n = targets.count()
    if n <= LOCAL_TARGET_ROWS:
        local = targets.sparkSession.createDataFrame(targets.collect(), targets.schema)
        targets.unpersist()
        return local
    return targets


def _checked(value, bad) -> Column:
    return F.when(bad, F.raise_error(F.lit("order-statistic sketch bracket missed")).cast("double")).otherwise(value)


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Iterable[float],
    by: Sequence[str] = (),
    accuracy: int = DEFAULT_ACCURACY,
    max_candidates: int = MAX_CANDIDATES,
) -> DataFrame:
    """Exact linear-interpolated quantiles, long format.

    Returns ``(by..., column, prob, n, quantile)``; groups/columns without a
    non-null value produce no row.  Without ``by``, three scans answer any number
    of columns (see ``_quantiles_wide``, also for ``max_candidates``).
    """
    by = list(by)
    probs = sorted({float(p) for p in probs})
    if not by:
        return _quantiles_wide(df, list(cols), probs, accuracy, max_candidates)
    keys = by + ["column"]
    values = long_values(df, cols, by)
    pos = [(F.col("n") - 1) * F.lit(p) for p in probs]
    targets = _brackets(values, keys, probs, accuracy).select(
        *keys,
        "n",
        "lo",
        "hi",
        F.array(*[F.floor(x).cast("long") for x in pos]).alias("k"),
        F.array(*[F.least(F.floor(x).cast("long") + 1, F.col("n") - 1) for x in pos]).alias("k2"),
        F.array(*[x - F.floor(x) for x in pos]).alias("frac"),
    )
    targets = _materialise(targets)
    # ungrouped: one row per column, bounded by the call's arguments
    res = _resolve(values, targets, keys, len(probs), broadcast_targets=not by)
    meta = targets.select(*keys, "n", F.posexplode("frac").alias("pos", "frac"))
    res = res.join(meta, keys + ["pos"])
    prob = F.element_at(F.array(*[F.lit(p) for p in probs]), (F.col("pos") + 1).cast("int"))
    q = F.col("v1") + F.col("frac") * (F.col("v2") - F.col("v1"))
    return res.select(*keys, prob.alias("prob"), "n", _checked(q, F.col("bad")).alias("quantile"))


def _quantiles_wide(df: DataFrame, cols: list[str], probs: list[float], accuracy: int, max_candidates: int) -> DataFrame:
    """Ungrouped path: selection by repeated bracketing, every scan serving all columns.

    Scan 1 brackets each wanted rank by a sketch of its column.  Scan 2 counts the
    rows below, on and between the ends of each bracket and sketches what lies
    strictly between, which narrows the bracket again.  Scan 3 counts the distinct
    values of the narrowed brackets.  Scan 2 is repeated only for brackets that
    could hold more than ``max_candidates`` rows between their ends (at the defaults
    from some 10**10 rows on) or that missed their rank.  Copies of a value don't
    count: a hot value ends up as an end of its bracket.  Returns a small local frame.
    """
    spark = df.sparkSession
    schema = "column string, prob double, n long, quantile double"
    val = {c: F.col(c).cast("double") for c in cols}
    clean = {c: F.when(~F.isnan(val[c]), val[c]) for c in cols}
    asked = _constant(_bracket_probs(probs, accuracy))
    firsts = [
        x
        for i, c in enumerate(cols)
        for x in (F.count(clean[c]).alias(f"n{i}"), F.approx_percentile(clean[c], asked, accuracy).alias(f"br{i}"))
    ]
    r = df.agg(*firsts).first() if cols else {}
    targets = []
    for i, c in enumerate(cols):
        n = r[f"n{i}"]
        for j, p in enumerate(probs if n else []):
            lo, hi = _margin_ends(n, j, accuracy)
            k = int(math.floor((n - 1) * p))
            targets.append(_Target(c, p, n, k, min(k + 1, n - 1), (n - 1) * p - k, r[f"br{i}"][lo], r[f"br{i}"][hi]))
    todo = targets
    while todo:
        wide = todo
        while wide:
            _measure(df, clean, wide, accuracy, max_candidates)
            wide = [t for t in wide if t.state == "wide"]
        todo = [t for t in todo if t.state == "ready"]
        _select(df, clean, todo)
        todo = [t for t in todo if t.state == "wide"]
    return spark.createDataFrame([(t.column, t.prob, t.n, t.v1 + t.frac * (t.v2 - t.v1)) for t in targets], schema)


def _measure(df: DataFrame, clean: Mapping[str, Column], targets: list[_Target], accuracy: int, max_candidates: int) -> None:
    """One scan: where each target's bracket lies; solves, narrows or moves it."""
    grid = _constant([i / GRID for i in range(1, GRID)])
    aggs = []
    for i, t in enumerate(targets):
        v = clean[t.column]
        between = (v > F.lit(t.lo)) & (v < F.lit(t.hi))
        aggs += [
            F.count_if(v < F.lit(t.lo)).alias(f"b{i}"),
            F.count_if(v == F.lit(t.lo)).alias(f"l{i}"),
            F.count_if(between).alias(f"i{i}"),
            F.count_if(v == F.lit(t.hi)).alias(f"h{i}"),
            F.approx_percentile(F.when(between, v), grid, accuracy).alias(f"g{i}"),
        ]
    r = df.agg(*aggs).first()
    for i, t in enumerate(targets):
        upto_lo = r[f"b{i}"] + r[f"l{i}"]
        below_hi = upto_lo + r[f"i{i}"]
        upto_hi = below_hi + (r[f"h{i}"] if t.hi > t.lo else 0)
        if t.missed(r[f"b{i}"], upto_hi):
            continue
        if t.k2 < upto_lo or t.k >= below_hi or upto_lo == below_hi:
            t.solve(t.lo if t.k < upto_lo else t.hi, t.lo if t.k2 < upto_lo else t.hi)
            continue
        inside = below_hi - upto_lo
        t.state = "ready"
        if inside <= max_candidates:
            continue
        # ends whose places inside are certain: a grid point is off by one rank and the sketch's error
        slack = inside / accuracy + 2
        first, last = t.k - upto_lo, t.k2 - upto_lo
        a = math.floor((first - slack) / inside * GRID)
        b = math.ceil((last + slack) / inside * GRID)
        t.outer = (t.lo, t.hi)
        t.lo, t.hi = (r[f"g{i}"][a - 1] if a >= 1 else t.lo), (r[f"g{i}"][b - 1] if b < GRID else t.hi)
        if (t.lo, t.hi) != t.outer and (b - a) / GRID * inside + 2 * slack > max_candidates:
            t.state = "wide"


def _select(df: DataFrame, clean: Mapping[str, Column], targets: list[_Target]) -> None:
    """One scan: the exact order statistics from the distinct values of the brackets.

    Rows are grouped by what they put into brackets (nothing, for nearly all of
    them), so rows below brackets are counted, and copies merged, before the shuffle.
    """
    if not targets:
        return
    hits = F.array(
        *[
            F.when(clean[t.column].between(t.lo, t.hi), F.struct(F.lit(i).alias("pos"), clean[t.column].alias("cv")))
            for i, t in enumerate(targets)
        ]
    )
    grouped = df.groupBy(F.filter(hits, lambda x: x.isNotNull()).alias("hits")).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.array(*[F.count_if(clean[t.column] < F.lit(t.lo)) for t in targets]).alias("below"),
    )
    cells = F.concat(
        F.transform("hits", lambda x: F.struct(x["pos"].alias("pos"), x["cv"].alias("cv"), F.col("cnt").alias("cnt"))),
        F.transform("below", lambda b, i: F.struct(i.alias("pos"), F.lit(None).cast("double").alias("cv"), b.alias("cnt"))),
    )
    counts = grouped.select(F.inline(cells)).groupBy("pos", "cv").agg(F.sum("cnt").alias("cnt"))
    # the row without a value (rows below the bracket) sorts first; a bracket holds a bounded number of values
    w = Window.partitionBy("pos").orderBy(F.col("cv").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = df.sparkSession.createDataFrame([(i, t.k, t.k2) for i, t in enumerate(targets)], "pos int, k long, k2 long")
    found = (
        counts.withColumn("cum", F.sum("cnt").over(w))
        .join(F.broadcast(ranks), "pos")
        .groupBy("pos")
        .agg(
            F.sum(F.when(F.col("cv").isNull(), F.col("cnt"))).alias("below"),
            F.sum("cnt").alias("upto_hi"),
            F.min(F.when(F.col("cum") > F.col("k"), F.col("cv"))).alias("v1"),
            F.min(F.when(F.col("cum") > F.col("k2"), F.col("cv"))).alias("v2"),
        )
        .collect()
    )
    for x in found:
        t = targets[x["pos"]]
        if not t.missed(x["below"], x["upto_hi"]):
            t.solve(x["v1"], x["v2"])


def kth_smallest(df: DataFrame, col: str, by: str, ranks: Mapping, prob: float | Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Exact k-th smallest (1-based) value of ``col`` per group value of ``by``.

    ``ranks`` maps a group value to k or to a list of k's (one per position,
    the same number for every group); ``prob`` gives, per position, the
    constant fraction the ranks sit near (it only centres the sketch bracket;
    each k must lie within ~accuracy^-1 of prob * n_group, as stratified sizes
    do).  Returns (by, pos, k, value).
    """
    probs = [float(prob)] if isinstance(prob, (int, float)) else [float(p) for p in prob]
    rows = []
    for g, ks in ranks.items():
        ks = [ks] if isinstance(ks, int) else list(ks)
        if len(ks) != len(probs):
            raise ValueError("one rank per position is required for every group")
        rows.append((g, [int(k) - 1 for k in ks]))
    spark = df.sparkSession
    gtype = df.schema[by].dataType
    kdf = spark.createDataFrame(rows, T.StructType([T.StructField(by, gtype), T.StructField("k", T.ArrayType(T.LongType()))]))
    values = df.select(by, F.col(col).cast("double").alias("value")).where(F.col("value").isNotNull())
    # one row per requested group: bounded by ``ranks``
    targets = _materialise(_brackets(values, [by], probs, accuracy).join(F.broadcast(kdf), by).withColumn("k2", F.col("k")))
    res = _resolve(values, targets, [by], len(probs), broadcast_targets=True)
    kk = targets.select(by, F.posexplode("k").alias("pos", "k0"))
    return res.join(kk, [by, "pos"]).select(by, "pos", (F.col("k0") + 1).alias("k"), _checked(F.col("v1"), F.col("bad")).alias("value"))


def quantile_map(df: DataFrame, cols: Sequence[str], probs: Iterable[float], **kw) -> dict[tuple[str, float], float]:
    """Ungrouped ``quantiles`` collected into {(column, prob): value} (len(cols)*len(probs) rows)."""
    if not cols:
        return {}
    rows = quantiles(df, cols, probs, **kw).collect()
    return {(r["column"], float(r["prob"])): r["quantile"] for r in rows}


def grouped_quantile_column(df: DataFrame, col: str, prob: float, by: Sequence[str], name: str) -> DataFrame:
    """(by..., name) — the exact ``prob`` quantile of ``col`` per group."""
    return quantiles(df, [col], [prob], by=by).select(*by, F.col("quantile").alias(name))


def _bucket_of(col: Column, cuts: Sequence[float]) -> Column:
    """Index of the cut interval (number of cuts <= value), as a balanced CASE tree (stays in codegen)."""

    def build(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2  # value >= cuts[mid-1] -> answer >= mid
        return F.when(col >= F.lit(cuts[mid - 1]), build(mid, hi)).otherwise(build(lo, mid - 1))

    return build(0, len(cuts))


def _with_buckets(base: DataFrame, n: int, rows_per_bucket: int, max_buckets: int) -> DataFrame:
    """``base`` of ``n`` rows with ``_bucket``, about ``rows_per_bucket`` rows each, in the order of ``_ord``.

    Beyond ``max_buckets`` each range is cut again at its own sketch's points
    (one broadcast row per range).
    """
    wanted = max(1, math.ceil(n / rows_per_bucket))
    n_buckets = min(max_buckets, wanted)
    if n_buckets == 1 and wanted == 1:
        return base.withColumn("_bucket", F.lit(0).cast("long"))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    acc = max(DEFAULT_ACCURACY, 20 * n_buckets)
    cuts = sorted(set(base.agg(F.approx_percentile("_ord", probs, acc)).first()[0])) if probs else []
    base = base.withColumn("_bucket", _bucket_of(F.col("_ord"), cuts).cast("long"))
    if wanted <= max_buckets:
        return base
    parts = math.ceil(wanted / max_buckets)
    inner = base.groupBy("_bucket").agg(F.approx_percentile("_ord", [i / parts for i in range(1, parts)], max(DEFAULT_ACCURACY, 20 * parts)).alias("_cuts"))
    behind = F.size(F.filter("_cuts", lambda c: c <= F.col("_ord")))
    return base.join(F.broadcast(inner), "_bucket", "left").withColumn("_bucket", F.col("_bucket") * parts + F.when(F.col("_cuts").isNull(), 0).otherwise(behind)).drop("_cuts")


def running_totals(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    descending: bool = False,
    rows_per_bucket: int = 2_000_000,
    max_buckets: int = 4096,
) -> DataFrame:
    """Add ``<c>_cum`` (inclusive running sum of ``c`` in ``order_col`` order) for each ``c``.

    ``order_col`` must be unique per row (group by it first).  Runs one count,
    one sketch for cut points (<= max_buckets values reach the driver; beyond,
    the ranges are cut again, see ``_with_buckets``), one
    bucket-total aggregate and one window partitioned by bucket.
    """
    sign = -1.0 if descending else 1.0
    key = (F.col(order_col).cast("double") * F.lit(sign)).alias("_ord")
    base = df.withColumn("_ord", key)
    n = base.count()
    base = _with_buckets(base, n, rows_per_bucket, max_buckets)
    totals = base.groupBy("_bucket").agg(*[F.sum(c).alias(f"_{c}_bt") for c in sum_cols])
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", *[F.coalesce(F.sum(f"_{c}_bt").over(wb), F.lit(0)).alias(f"_{c}_off") for c in sum_cols]
    )
    # one row per bucket, n / rows_per_bucket: a small broadcast
    joined = base.join(F.broadcast(offsets), "_bucket")
    w = Window.partitionBy("_bucket").orderBy("_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined.select(
        *df.columns,
        *[(F.col(f"_{c}_off") + F.sum(c).over(w)).alias(f"{c}_cum") for c in sum_cols],
    )
    return out
