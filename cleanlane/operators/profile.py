"""Profiling aggregates.

Every multi-column statistic is one ``agg`` over all requested columns (a single
scan with map-side partial aggregation); results are small long-format
DataFrames (one row per column or per group), never driver loops over columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null, numeric_columns
from . import stats


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def _unpivot(row_df: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row aggregate with columns ``<field>__<name>`` into rows (column, field...)."""
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{f}__{i}").cast(t).alias(f) for f, t in fields.items()])
        for i, n in enumerate(names)
    ]
    return row_df.select(F.inline(F.array(*structs)))


# --------------------------------------------------------------------- A1 / P4
def null_profile(df: DataFrame, cols: Sequence[str] | None = None, nonzero_only: bool = True) -> DataFrame:
    """A1: (column, null_count, null_pct) — percent of rows; non-zero rows only, sorted by count desc."""
    df = nan_to_null(df)
    cols = list(cols or df.columns)
    if not cols:
        return _empty(df, "column string, null_count long, null_pct double")
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls__{i}") for i, c in enumerate(cols)])
    out = row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"nulls__{i}").alias("null_count"),
                        (F.col(f"nulls__{i}") * F.lit(100.0) / F.col("_n")).alias("null_pct"),
                    )
                    for i, c in enumerate(cols)
                ]
            )
        )
    )
    if nonzero_only:
        out = out.where(F.col("null_count") > 0)
    return out.orderBy(F.col("null_count").desc(), F.col("column"))


def null_fractions(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """{column: null fraction} from one aggregate (fit step of F1)."""
    df = nan_to_null(df)
    cols = list(cols or df.columns)
    if not cols:
        return {}
    r = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"f{i}") for i, c in enumerate(cols)]).first()
    return {c: (r[f"f{i}"] if r[f"f{i}"] is not None else 0.0) for i, c in enumerate(cols)}


# ---------------------------------------------------------------- A4 / A5
def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """A4: (column, prob, quantile) — exact, linear interpolation."""
    return stats.quantiles(df, cols, probs).select("column", "prob", "quantile")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: count, mean, sample std, min, exact quartiles, max per numeric column."""
    df = nan_to_null(df)
    cols = list(cols or numeric_columns(df))
    if not cols:
        return _empty(df, "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")
    moments = df.agg(
        *[
            x
            for i, c in enumerate(cols)
            for x in (
                F.count(c).alias(f"count__{i}"),
                F.avg(c).alias(f"mean__{i}"),
                F.stddev_samp(c).alias(f"std__{i}"),
                F.min(F.col(c).cast("double")).alias(f"min__{i}"),
                F.max(F.col(c).cast("double")).alias(f"max__{i}"),
            )
        ]
    )
    m = _unpivot(moments, cols, {"count": "long", "mean": "double", "std": "double", "min": "double", "max": "double"})
    q = (
        stats.quantiles(df, cols, [0.25, 0.5, 0.75])
        .groupBy("column")
        .pivot("prob", [0.25, 0.5, 0.75])
        .agg(F.first("quantile"))
        .toDF("column", "q25", "q50", "q75")
    )
    # both sides hold one row per column
    return m.join(F.broadcast(q), "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


# ------------------------------------------------------------------- A6 / A7
def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """(value, count[, fraction]) desc by count, ties by value asc; nulls excluded."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = df.where(F.col(col).isNotNull()).count()
        vc = vc.withColumn("fraction", F.col("count") / F.lit(float(total) if total else float("nan")))
    return vc.orderBy(F.col("count").desc(), F.col("value"))


def top_values(df: DataFrame, col: str, k: int) -> list:
    """W2 over A6: the k most frequent non-null values (ties by value asc), k values to the driver."""
    return [r["value"] for r in value_counts(df, col).limit(k).collect()]


def nunique(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique) — distinct non-null values per column, one aggregate."""
    cols = list(cols or df.columns)
    if not cols:
        return _empty(df, "column string, n_unique long")
    row = df.agg(*[F.count_distinct(F.col(c)).alias(f"nunique__{i}") for i, c in enumerate(cols)])
    return _unpivot(row, cols, {"nunique": "long"}).withColumnRenamed("nunique", "n_unique")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A7 ``unique``: distinct non-null values (distributed)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


# ---------------------------------------------------------------------- A8
def rate_by_group(df: DataFrame, key: str, target: str) -> DataFrame:
    """Per non-null key: count, sum and mean of target, sorted by mean desc."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(target).alias("count"),
            F.sum(F.col(target).cast("long")).alias("sum"),
            F.avg(F.col(target).cast("double")).alias("mean"),
        )
        .orderBy(F.col("mean").desc(), F.col(key))
    )


# ------------------------------------------------------------------- A9 / A10
def crosstab(df: DataFrame, a: str, b: str, wide: bool = False) -> DataFrame:
    """Contingency counts of non-null (a, b) pairs, long (a, b, count) or pivoted on b."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
    if not wide:
        return cells
    return cells.groupBy(a).pivot(b).agg(F.first("count")).fillna(0).orderBy(a)


#: Parts in which the cells of one column and class meet that class's total.
CLASS_SALTS = 64


def cramers_v(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """A10: (column, n, n_levels, chi2, cramers_v) of each column against ``target``.

    chi2 is Pearson's statistic over the full contingency table (absent cells
    count as 0); a 2x2 table gets the Yates continuity correction, as SciPy's
    ``chi2_contingency`` does by default.  Only grouped counts are computed
    (one shuffle for all columns together); V is null when a side has one level.
    """
    cols = list(cols)
    if not cols:
        return _empty(df, "column string, n long, n_levels long, chi2 double, cramers_v double")
    cells = (
        df.where(F.col(target).isNotNull())
        .select(
            F.col(target).cast("string").alias("y"),
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])),
        )
        .where(F.col("level").isNotNull())
        .groupBy("column", "level", "y")
        .agg(F.count(F.lit(1)).cast("double").alias("o"))
    )
    # marginals as grouped tables: level totals stay distributed (one row per level); class totals
    # are a row per column and class, which very many levels share: they are joined in salted parts
    cells = cells.withColumn("salt", F.pmod(F.xxhash64("level"), F.lit(CLASS_SALTS)).cast("int"))
    r_tab = cells.groupBy("column", "level").agg(F.sum("o").alias("r"))
    c_tab = cells.groupBy("column", "y").agg(F.sum("o").alias("c"))
    n_tab = c_tab.groupBy("column").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_classes"), F.sum(1.0 / F.col("c")).alias("inv_c"))
    lev_tab = r_tab.groupBy("column").agg(F.count(F.lit(1)).alias("n_levels"), F.sum(1.0 / F.col("r")).alias("inv_r"))
    salted = c_tab.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(CLASS_SALTS - 1))))
    joined = cells.join(r_tab, ["column", "level"]).join(salted, ["column", "y", "salt"]).join(F.broadcast(n_tab.select("column", "n")), "column")
    part = joined.groupBy("column").agg(
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("s"),
        F.max(F.abs(F.col("o") - F.col("r") * F.col("c") / F.col("n"))).alias("d"),
    )
    per = part.join(F.broadcast(n_tab), "column").join(F.broadcast(lev_tab), "column")
    yates = F.pow(F.greatest(F.col("d") - 0.5, F.lit(0.0)), 2) * F.col("n") * F.col("inv_r") * F.col("inv_c")
    chi2 = F.when((F.col("n_levels") == 2) & (F.col("n_classes") == 2), yates).otherwise(F.col("n") * (F.col("s") - 1.0))
    k = F.least(F.col("n_levels"), F.col("n_classes")) - 1
    return per.select(
        "column",
        F.col("n").cast("long").alias("n"),
        F.col("n_levels"),
        chi2.alias("chi2"),
        F.when(k > 0, F.sqrt(F.greatest(chi2, F.lit(0.0)) / (F.col("n") * k))).alias("cramers_v"),
    )


# ------------------------------------------------------------------ A11 / A12
def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over pairwise-complete rows; null (not an ANSI error) when a side is constant."""
    xx = F.when(y.isNotNull(), x.cast("double"))
    yy = F.when(x.isNotNull(), y.cast("double"))
    return F.try_divide(F.covar_pop(xx, yy), F.sqrt(F.var_pop(xx) * F.var_pop(yy)))


def corr_with_target(df: DataFrame, cols: Sequence[str] | None, target: str) -> DataFrame:
    """(column, correlation, abs_correlation) sorted by |r| desc; one aggregate."""
    cols = [c for c in (cols if cols is not None else numeric_columns(df)) if c != target]
    if not cols:
        return _empty(df, "column string, correlation double, abs_correlation double")
    row = df.agg(*[safe_corr(F.col(c), F.col(target)).alias(f"r__{i}") for i, c in enumerate(cols)])
    out = _unpivot(row, cols, {"r": "double"}).withColumnRenamed("r", "correlation")
    return out.withColumn("abs_correlation", F.abs("correlation")).orderBy(F.col("abs_correlation").desc_nulls_last(), "column")


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None, fill_null: float | None = None) -> DataFrame:
    """Long (col_a, col_b, correlation) for every pair a<b (lower triangle), over the rows that have both.

    Two passes at any number of columns: means, then one distributed Gram
    matrix.  Where values are missing its columns are the deviations d from the
    mean, d squared and a flag of presence, whose products hold the count, sums
    and products of every pair's common rows.  Null and NaN are missing; r is
    null where a side does not vary over the common rows.
    """
    cols = list(cols or numeric_columns(df))
    schema = "col_a string, col_b string, correlation double"
    k = len(cols)
    if k < 2:
        return df.sparkSession.createDataFrame([], schema)
    src = nan_to_null(df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]))
    x = [F.col(f"x{i}") if fill_null is None else F.coalesce(f"x{i}", F.lit(float(fill_null))) for i in range(k)]
    r = src.agg(F.count(F.lit(1)).alias("n"), *[f(v).alias(f"{name}{i}") for i, v in enumerate(x) for name, f in (("n", F.count), ("m", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    if not r["n"]:
        return df.sparkSession.createDataFrame([(cols[i], cols[j], None) for i in range(k) for j in range(i + 1, k)], schema)
    fixed = np.array([r[f"lo{i}"] == r[f"hi{i}"] for i in range(k)])
    mean = [r[f"lo{i}"] if fixed[i] else r[f"m{i}"] for i in range(k)]
    dev = [F.coalesce(v - F.lit(float(m or 0.0)), F.lit(0.0)) for v, m in zip(x, mean)]
    if all(r[f"n{i}"] == r["n"] for i in range(k)):
        g = stats.gram(src, dev)
        cov, var_a = g, np.repeat(np.diag(g)[:, None], k, axis=1)
        least = np.zeros_like(cov)
    else:
        g = stats.gram(src, [*dev, *[d * d for d in dev], *[v.isNotNull().cast("double") for v in x]])
        n, total, squares = g[2 * k :, 2 * k :], g[:k, 2 * k :], g[k : 2 * k, 2 * k :]  # of column i over the rows that have j
        with np.errstate(divide="ignore", invalid="ignore"):
            cov = g[:k, :k] - total * total.T / n
            var_a = squares - total * total / n
        least = 1e-13 * squares  # what rounding leaves of a side that does not vary
    varies = (var_a > least) & (var_a.T > least.T) & ~fixed[:, None] & ~fixed[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = cov / np.sqrt(var_a * var_a.T)
    rows = [(cols[i], cols[j], float(corr[i, j]) if varies[i, j] else None) for i in range(k) for j in range(i + 1, k)]
    return df.sparkSession.createDataFrame(rows, schema)


# ------------------------------------------------------------------ A13 / C3
def iqr_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (q1, q3)} exact quartiles of each column (one quantile job)."""
    qm = stats.quantile_map(df, cols, [0.25, 0.75])
    return {c: (qm.get((c, 0.25)), qm.get((c, 0.75))) for c in cols if qm.get((c, 0.25)) is not None}


def outlier_counts(df: DataFrame, cols: Sequence[str] | None = None, k_mild: float = 1.5, k_extreme: float = 3.0) -> DataFrame:
    """Per column q1, q3, iqr, fences and counts of all (beyond 1.5 IQR), extreme (beyond 3 IQR) and mild outliers."""
    df = nan_to_null(df)
    cols = list(cols or numeric_columns(df))
    q = (
        stats.quantiles(df, cols, [0.25, 0.75])
        .groupBy("column")
        .pivot("prob", [0.25, 0.75])
        .agg(F.first("quantile"))
        .toDF("column", "q1", "q3")
    )
    qr = {r["column"]: (r["q1"], r["q3"]) for r in q.collect()}
    aggs = []
    names = []
    for i, c in enumerate(cols):
        if c not in qr:
            continue
        q1, q3 = qr[c]
        iqr = q3 - q1
        lo, hi = q1 - k_mild * iqr, q3 + k_mild * iqr
        elo, ehi = q1 - k_extreme * iqr, q3 + k_extreme * iqr
        v = F.col(c)
        names.append(c)
        j = len(names) - 1
        aggs += [
            F.count_if((v < lo) | (v > hi)).alias(f"all__{j}"),
            F.count_if((v < elo) | (v > ehi)).alias(f"extreme__{j}"),
        ]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, q1 double, q3 double, iqr double, lower double, upper double, n_outliers long, n_extreme long, n_mild long")
    row = df.agg(*aggs)
    counts = _unpivot(row, names, {"all": "long", "extreme": "long"})
    bounds = df.sparkSession.createDataFrame(
        [(c, float(qr[c][0]), float(qr[c][1])) for c in names], "column string, q1 double, q3 double"
    )
    return (
        counts.join(F.broadcast(bounds), "column")
        .select(
            "column",
            "q1",
            "q3",
            (F.col("q3") - F.col("q1")).alias("iqr"),
            (F.col("q1") - k_mild * (F.col("q3") - F.col("q1"))).alias("lower"),
            (F.col("q3") + k_mild * (F.col("q3") - F.col("q1"))).alias("upper"),
            F.col("all").alias("n_outliers"),
            F.col("extreme").alias("n_extreme"),
            (F.col("all") - F.col("extreme")).alias("n_mild"),
        )
    )


# ---------------------------------------------------------------------- A14
def scalar_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, min, max, mean, sum, std, var) with sample std/var; one aggregate."""
    df = nan_to_null(df)
    cols = list(cols or numeric_columns(df))
    if not cols:
        return _empty(df, "column string, min double, max double, mean double, sum double, std double, var double")
    row = df.agg(
        *[
            x
            for i, c in enumerate(cols)
            for x in (
                F.min(F.col(c).cast("double")).alias(f"min__{i}"),
                F.max(F.col(c).cast("double")).alias(f"max__{i}"),
                F.avg(c).alias(f"mean__{i}"),
                F.sum(F.col(c).cast("double")).alias(f"sum__{i}"),
                F.stddev_samp(c).alias(f"std__{i}"),
                F.var_samp(c).alias(f"var__{i}"),
            )
        ]
    )
    return _unpivot(row, cols, {k: "double" for k in ("min", "max", "mean", "sum", "std", "var")})


# ---------------------------------------------------------------------- A16
def histogram(df: DataFrame, col: str, bins: int = 20, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram (bucket, lower, upper, count) like NumPy: last bin is closed.

    ``width_bucket`` puts the maximum in bucket bins+1, so it is folded into bin
    ``bins``.  Empty buckets are omitted.  Range defaults to [min, max] (one aggregate).
    """
    df = nan_to_null(df, [col])
    v = F.col(col).cast("double")
    if lo is None or hi is None:
        r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    if lo is None:
        return df.sparkSession.createDataFrame([], "bucket int, lower double, upper double, count long")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.greatest(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(1)), F.lit(bins)).cast("int")
    return (
        df.where(v.isNotNull() & (v >= lo) & (v <= hi))
        .groupBy(b.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bucket",
            (F.lit(lo) + (F.col("bucket") - 1) * F.lit(width)).alias("lower"),
            (F.lit(lo) + F.col("bucket") * F.lit(width)).alias("upper"),
            "count",
        )
        .orderBy("bucket")
    )


def unit_histogram(df: DataFrame, col: str) -> DataFrame:
    """A16 with unit bins: counts per integer value (value, count)."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy("value")


# ---------------------------------------------------------------------- A17
def boxplot_stats(df: DataFrame, cols: Sequence[str] | None = None, whis: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, q1, median, q3, whisker_low, whisker_high, n_fliers).

    Whiskers are the most extreme data points inside the fences (matplotlib).
    """
    cols = list(cols or numeric_columns(df))
    by = list(by)
    q = stats.quantiles(df, cols, [0.25, 0.5, 0.75], by=by)
    qw = q.groupBy(*by, "column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("quantile")).toDF(*by, "column", "q1", "median", "q3")
    qw = qw.withColumn("lo_f", F.col("q1") - whis * (F.col("q3") - F.col("q1"))).withColumn(
        "hi_f", F.col("q3") + whis * (F.col("q3") - F.col("q1"))
    )
    vals = stats.long_values(df, cols, by)
    if by:
        met = stats.met_in_parts(vals, qw, by + ["column"])
    else:  # one row per column, bounded by the call
        met = vals.withColumn("copies", F.lit(1)).join(F.broadcast(qw), "column")
    inner = met.groupBy(*by, "column").agg(
        F.min(F.when(F.col("value") >= F.col("lo_f"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("hi_f"), F.col("value"))).alias("whisker_high"),
        F.sum(F.when((F.col("value") < F.col("lo_f")) | (F.col("value") > F.col("hi_f")), F.col("copies")).otherwise(0)).cast("long").alias("n_fliers"),
    )
    return qw.join(inner, by + ["column"]).select(*by, "column", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers")


# ---------------------------------------------------------------------- A18
def indicator_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, ones) — count of ones per 0/1 flag column, one aggregate."""
    cols = list(cols)
    if not cols:
        return _empty(df, "column string, ones long")
    row = df.agg(*[F.sum(F.col(c).cast("long")).alias(f"ones__{i}") for i, c in enumerate(cols)])
    return _unpivot(row, cols, {"ones": "long"})


# ---------------------------------------------------------------------- P14
def class_balance(df: DataFrame, target: str) -> DataFrame:
    """(label, count, fraction) per non-null target value."""
    total = F.sum("count").over(Window.partitionBy())
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    # the class table has one row per label value: the unpartitioned window sees a handful of rows
    return counts.withColumn("fraction", F.col("count") / total).orderBy("label")
