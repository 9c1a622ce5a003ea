"""Column screening.

* ``screen_by_target_corr`` (C10/C11): numeric columns by Pearson r with the
  target (nulls filled with the median first); categorical columns by the
  strongest one-hot level (a null level included).  The level correlations
  come from grouped counts and a closed form, so no dummy column is ever
  materialised: for a 0/1 dummy d of a level with n rows and target sum s,
  r = (N*s - n*T1) / sqrt(n*(N-n) * (N*T2 - T1^2)) with N rows, T1 = sum t,
  T2 = sum t^2.
* ``moment_matrix``: centred cross-products of k numeric columns in two
  passes (means, then a distributed Gram matrix of the deviations); only the
  k x k matrix reaches the driver.  It feeds the correlated-pair rule (C12) and the
  variance inflation factors (C13): with the uncentred Gram G = X'X,
  VIF_i = 1 / (1 - R^2_i) = G_ii (G^-1)_ii of x_i regressed on the rest without
  intercept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC, numeric_columns
from . import stats
from .profile import safe_corr

NUMERIC_SCREEN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ------------------------------------------------------------------ C10 / C11
def screen_table(
    df: DataFrame,
    target: str,
    hi: float = 0.5,
    lo: float = 0.2,
    status_col: str | None = "reservation_status",
    status_pattern: str = "cancel",
) -> list[dict]:
    """Decision rows for every non-target numeric and string column.

    Row keys: column, type (numeric / categorical / special_reservation_status),
    correlation, abs_correlation, best_category, reason (leakage / not_relevant
    / useful / constant), drop (bool).  Jobs: one null/median job for numeric
    columns, one aggregate of r, one grouped level table for string columns.
    """
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_SCREEN) and f.name != target]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != target]
    out: list[dict] = []
    t = F.col(target).cast("double")

    if num:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(num)]).first()
        need = [c for i, c in enumerate(num) if nulls[f"n{i}"] > 0]
        med = stats.quantile_map(df, need, [0.5]) if need else {}
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(med.get((c, 0.5)) or 0.0))) for c in num}
        row = df.agg(
            *[
                x
                for i, c in enumerate(num)
                for x in (
                    safe_corr(filled[c], t).alias(f"r{i}"),
                    F.min(filled[c]).alias(f"mn{i}"),
                    F.max(filled[c]).alias(f"mx{i}"),
                )
            ]
        ).first()
        for i, c in enumerate(num):
            if row[f"mn{i}"] is None or row[f"mn{i}"] == row[f"mx{i}"]:
                out.append(dict(column=c, type="numeric", correlation=None, abs_correlation=None, best_category=None, reason="constant", drop=False))
                continue
            r = row[f"r{i}"]
            if r is None or np.isnan(r):
                continue
            a = abs(r)
            reason = "leakage" if a >= hi else ("not_relevant" if a < lo else "useful")
            out.append(dict(column=c, type="numeric", correlation=r, abs_correlation=a, best_category=None, reason=reason, drop=reason != "useful"))

    if cat:
        lv = level_correlations(df, cat, target)
        best = (
            lv.where(F.col("r").isNotNull())
            .groupBy("column")
            .agg(F.min(F.struct((-F.abs("r")).alias("neg"), F.col("is_null_level"), F.col("level"), F.col("r"))).alias("b"))
            .select("column", F.col("b.r").alias("r"), F.col("b.level").alias("level"), F.col("b.is_null_level").alias("isnull"))
        )
        n_levels = lv.where(~F.col("is_null_level")).groupBy("column").agg(F.count(F.lit(1)).alias("k"))
        info = {r["column"]: r for r in best.collect()}
        kinfo = {r["column"]: r["k"] for r in n_levels.collect()}
        for c in cat:
            if kinfo.get(c, 0) <= 1:
                out.append(dict(column=c, type="categorical", correlation=None, abs_correlation=None, best_category=None, reason="constant", drop=False))
                continue
            b = info.get(c)
            if b is None:
                continue
            a = abs(b["r"])
            reason = "leakage" if a >= hi else ("not_relevant" if a < lo else "useful")
            best_name = f"{c}_nan" if b["isnull"] else f"{c}_{b['level']}"
            out.append(dict(column=c, type="categorical", correlation=b["r"], abs_correlation=a, best_category=best_name, reason=reason, drop=reason != "useful"))
        if status_col and status_col in cat:
            leaky = (
                lv.where((F.col("column") == status_col) & ~F.col("is_null_level") & F.lower("level").contains(status_pattern.lower()))
                .where(F.abs("r") >= hi)
                .orderBy("level")
                .limit(1)
                .collect()
            )
            if leaky and not any(d["column"] == status_col and d["drop"] for d in out):
                r = leaky[0]["r"]
                out = [d for d in out if d["column"] != status_col]
                out.append(dict(column=status_col, type="special_reservation_status", correlation=r, abs_correlation=abs(r), best_category=f"{status_col}_{leaky[0]['level']}", reason="leakage", drop=True))
    return out


def level_correlations(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(column, level, is_null_level, n, s, r): Pearson r of each level's 0/1 dummy with the target.

    One grouped count over all columns (map-side combined, so a dominant level
    costs nothing extra); a null level is a level of its own (``dummy_na``).
    r is null for a dummy without variation or a constant target.
    """
    t = F.col(target).cast("double")
    # every column's levels partition all rows, so the totals are the same for all columns: one tiny aggregate
    tot = df.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(t).alias("t1"), F.sum(t * t).alias("t2")).first()
    big_n, t1, t2 = (F.lit(float(tot[x] or 0.0)) for x in ("n", "t1", "t2"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    lv = (
        df.select(t.alias("_t"), F.inline(cells))
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("_t").alias("s"))
        .withColumn("is_null_level", F.col("level").isNull())
    )
    num = big_n * F.col("s") - F.col("n") * t1
    den = F.sqrt(F.col("n") * (big_n - F.col("n")) * (big_n * t2 - t1 * t1))
    return lv.select("column", "level", "is_null_level", "n", "s", F.try_divide(num, F.when(den > 0, den)).alias("r"))


def screen_by_target_corr(df: DataFrame, target: str = "is_canceled", hi: float = 0.5, lo: float = 0.2, status_col: str | None = "reservation_status") -> tuple[DataFrame, list[dict]]:
    """Drop leakage (|r| >= hi) and irrelevant (|r| < lo) columns; returns (frame, decisions)."""
    if target not in df.columns:
        return df, []
    rows = screen_table(df, target, hi, lo, status_col)
    drop = list(dict.fromkeys(d["column"] for d in rows if d["drop"]))
    return df.drop(*drop), rows


def decisions_frame(spark, rows: list[dict]) -> DataFrame:
    schema = "column string, type string, correlation double, abs_correlation double, best_category string, reason string, drop boolean"
    return spark.createDataFrame([(d["column"], d["type"], d["correlation"], d["abs_correlation"], d["best_category"], d["reason"], d["drop"]) for d in rows], schema)


# ------------------------------------------------------------------ moments
@dataclass
class Moments:
    cols: list[str]
    n: int
    mean: np.ndarray
    cross: np.ndarray  # centred cross-products sum (x_i - m_i)(x_j - m_j)
    extra: dict = field(default_factory=dict)

    @property
    def var(self) -> np.ndarray:
        return np.diag(self.cross) / max(self.n - 1, 1)

    @property
    def corr(self) -> np.ndarray:
        d = np.sqrt(np.diag(self.cross))
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.cross / np.outer(d, d)

    @property
    def gram(self) -> np.ndarray:
        """Uncentred X'X."""
        return self.cross + self.n * np.outer(self.mean, self.mean)


def moment_matrix(df: DataFrame, cols: Sequence[str], fill: float | None = 0.0) -> Moments:
    """Two passes: means, then sums of centred products (numerically stable).

    Without ``fill``, a null stands for the column's mean.
    """
    cols = list(cols)
    x = {c: (F.coalesce(F.col(c).cast("double"), F.lit(float(fill))) if fill is not None else F.col(c).cast("double")) for c in cols}
    r = df.agg(F.count(F.lit(1)).alias("n"), *[f(x[c]).alias(f"{name}{i}") for i, c in enumerate(cols) for name, f in (("m", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    n, k = int(r["n"]), len(cols)
    mean = np.array([r[f"m{i}"] or 0.0 for i in range(k)], dtype=float)
    # a constant column has deviations of exactly 0
    fixed = [r[f"lo{i}"] == r[f"hi{i}"] for i in range(k)]
    mean = np.array([r[f"lo{i}"] if fixed[i] and r[f"lo{i}"] is not None else mean[i] for i in range(k)], dtype=float)
    if not n or not k:
        return Moments(cols, n, mean, np.zeros((k, k)))
    return Moments(cols, n, mean, stats.gram(df, [F.coalesce(x[c] - F.lit(float(mean[i])), F.lit(0.0)) for i, c in enumerate(cols)]))


# ---------------------------------------------------------------------- C12
def correlated_pairs(m: Moments, threshold: float = 0.8) -> tuple[list[tuple[str, str, float, str]], set[str]]:
    """Every pair i<j with |r| > threshold; the lower sample-variance column is dropped (second on a tie).

    Not greedy: already-dropped columns still take part (reference semantics).
    """
    r = np.abs(m.corr)
    var = m.var
    pairs, drop = [], set()
    for i in range(len(m.cols)):
        for j in range(i + 1, len(m.cols)):
            v = r[i, j]
            if np.isfinite(v) and v > threshold:
                loser = m.cols[i] if var[i] < var[j] else m.cols[j]
                pairs.append((m.cols[i], m.cols[j], float(v), loser))
                drop.add(loser)
    return pairs, drop


# ---------------------------------------------------------------------- C13
@dataclass
class Factors:
    """The inverse of the Gram matrix of the columns still there, from which all their VIFs follow at once.

    With G = X'X, the residual of column j on the others is 1 / (G^-1)_jj.  G is
    scaled to a unit diagonal and inverted by its eigenvectors; ``null`` marks
    columns in its null space, which others explain without any residual.
    Taking a column out is a rank-one downdate of the inverse.
    """

    m: Moments
    idx: list[int]
    inverse: np.ndarray
    null: np.ndarray

    @classmethod
    def of(cls, m: Moments, cols: Sequence[str]) -> Factors:
        idx = [m.cols.index(c) for c in cols]
        g = m.gram[np.ix_(idx, idx)]
        size = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
        values, vectors = np.linalg.eigh(g / np.outer(size, size))
        gone = values <= len(idx) * 1e-14 * max(1.0, values.max(initial=0))
        kept = vectors[:, ~gone]
        null = (vectors[:, gone] ** 2).sum(axis=1) > 1e-9 if gone.any() else np.zeros(len(idx), bool)
        inverse = (kept / values[~gone]) @ kept.T / np.outer(size, size)
        return cls(m, idx, inverse, null)

    def scores(self) -> dict[str, float]:
        """VIF of each column against the others, no intercept (uncentred R^2); nan for a column of zeros.

        Mirrors OLS conventions: if another column is a non-zero constant the
        model has an implicit intercept and R^2 is centred.
        """
        if len(self.idx) < 2:
            return {}
        cross, mean = np.diag(self.m.cross)[self.idx], self.m.mean[self.idx]
        raw = cross + self.m.n * mean**2
        constant = (cross <= 1e-12 * np.maximum(1.0, raw)) & (np.abs(mean) > 0)
        others = constant.sum() - constant
        total = np.where(others > 0, cross, raw)
        out = {}
        for j, i in enumerate(self.idx):
            if total[j] <= 0:
                out[self.m.cols[i]] = float("nan")
            elif self.null[j]:
                out[self.m.cols[i]] = float("inf")
            else:
                out[self.m.cols[i]] = max(1.0, float(total[j] * self.inverse[j, j]))
        return out

    def drop(self, col: str) -> None:
        j = self.idx.index(self.m.cols.index(col))
        rest = [a for a in range(len(self.idx)) if a != j]
        b = self.inverse[rest, j]
        self.inverse = self.inverse[np.ix_(rest, rest)] - np.outer(b, b) / self.inverse[j, j]
        self.null = self.null[rest]
        self.idx.pop(j)


def vif_scores(m: Moments, cols: Sequence[str]) -> dict[str, float]:
    """VIF of each column against the others (``Factors.scores``); inf where the others explain it wholly."""
    return Factors.of(m, cols).scores()


def drop_high_vif(m: Moments, cols: Sequence[str], threshold: float = 10.0, max_iter: int = 10) -> list[tuple[int, str, float]]:
    """Repeatedly drop the largest finite VIF above ``threshold`` (at most ``max_iter`` drops)."""
    factors, dropped = Factors.of(m, cols), []
    for it in range(max_iter):
        scores = {c: v for c, v in factors.scores().items() if np.isfinite(v)}
        if not scores:
            break
        worst = max(scores, key=lambda c: scores[c])
        if scores[worst] <= threshold:
            break
        dropped.append((it + 1, worst, scores[worst]))
        factors.drop(worst)
    return dropped


# ---------------------------------------------------------------------- C14
def clean_multicollinearity(df: DataFrame, target: str | None = "is_canceled", corr_threshold: float = 0.8, vif_threshold: float = 10.0, max_iter: int = 10) -> tuple[DataFrame, dict]:
    """C14: C12 then C13 on the numeric columns (target excluded, re-appended last)."""
    cols = numeric_columns(df, exclude=[target] if target else [])
    report: dict = {"pairs": [], "vif": [], "dropped": []}
    if len(cols) < 2:
        out = df
    else:
        m = moment_matrix(df, cols, fill=0.0)
        pairs, drop_corr = correlated_pairs(m, corr_threshold)
        remaining = [c for c in cols if c not in drop_corr]
        vif = drop_high_vif(m, remaining, vif_threshold, max_iter) if len(remaining) >= 2 else []
        drop_all = sorted(drop_corr | {c for _, c, _ in vif})
        report = {"pairs": pairs, "vif": vif, "dropped": drop_all}
        out = df.drop(*drop_all)
    if target and target in out.columns:
        out = out.select(*[c for c in out.columns if c != target], target)
    return out, report
