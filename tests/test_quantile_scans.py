"""Exact quantiles by repeated bracketing: few scans, any cap, hot values, missing values, tiny inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanlane.operators import stats

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def _frame(spark, n):
    rng = np.random.default_rng(n)
    cols = {
        "smooth": rng.normal(size=n),
        "hot": np.where(rng.random(n) < 0.6, 7.0, rng.normal(7, 3, size=n)),
        "ints": rng.integers(0, 5, n).astype(float),
        "same": np.full(n, 2.5),
    }
    rows = [tuple(float(cols[c][i]) for c in cols) for i in range(n)]
    return cols, spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))


@pytest.mark.parametrize("n,accuracy,cap", [(1, 100, 1), (2, 100, 1), (7, 10_000, 0), (3000, 100, 3), (3000, 50, 0), (3000, 10_000, 10**6)])
def test_quantiles_equal_numpy_at_any_cap(spark, n, accuracy, cap):
    cols, df = _frame(spark, n)
    got = {(r["column"], r["prob"]): (r["n"], r["quantile"]) for r in stats.quantiles(df, list(cols), PROBS, accuracy=accuracy, max_candidates=cap).collect()}
    for c in cols:
        for p in PROBS:
            assert got[c, p][0] == n
            assert got[c, p][1] == pytest.approx(np.quantile(cols[c], p), abs=1e-12), (c, p)


def test_three_scans_whatever_the_columns(spark, monkeypatch):
    scans = []
    for name in ("_measure", "_select"):
        real = getattr(stats, name)
        monkeypatch.setattr(stats, name, lambda *a, _r=real, _n=name: (scans.append(_n) if _n == "_measure" or a[2] else None, _r(*a))[1])
    df = spark.range(5000).select(*[F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(100_003)).cast("double").alias(f"c{i}") for i in range(40)])
    rows = stats.quantiles(df, df.columns, [0.25, 0.5, 0.75], accuracy=100, max_candidates=200).collect()
    assert scans == ["_measure", "_select"] and len(rows) == 120


def test_a_missed_bracket_is_moved(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    clean = {"v": F.col("v")}
    for lo, hi in [(700.0, 800.0), (3.0, 4.0), (499.5, 499.6)]:
        t = stats._Target("v", 0.5, 1000, 499, 500, 0.5, lo, hi)
        for _ in range(20):
            if t.state == "wide":
                stats._measure(df, clean, [t], 100, 5)
            elif t.state == "ready":
                stats._select(df, clean, [t])
        assert (t.state, t.v1, t.v2) == ("solved", 499.0, 500.0)


def test_missing_cells_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double")
    assert [(r["column"], r["n"], r["quantile"]) for r in stats.quantiles(df, ["a", "b"], [0.5]).collect()] == [("a", 2, 2.0)]
    assert stats.quantiles(df, [], [0.5]).collect() == []


@pytest.mark.parametrize("n", [1, 3, 20, 999])
def test_grouped_brackets_at_every_size(spark, n):
    rng = np.random.default_rng(n)
    v = {g: rng.normal(size=n * (g + 1)) for g in (0, 1)}
    df = spark.createDataFrame([(g, float(x)) for g in v for x in v[g]], "g int, v double")
    for r in stats.quantiles(df, ["v"], PROBS, by=["g"], accuracy=200).collect():
        assert r["quantile"] == pytest.approx(np.quantile(v[r["g"]], r["prob"]), abs=1e-12)
