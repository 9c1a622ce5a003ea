"""Pairwise correlations as one Gram product; class totals of a hot key."""

import numpy as np
import pandas as pd

from cleanlane.operators import profile


def as_map(frame):
    return {(r["col_a"], r["col_b"]): r["correlation"] for r in frame.collect()}


def test_corr_matrix_over_common_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) + 1e4
    x[:, 1] += 0.5 * x[:, 0]
    x[rng.random(x.shape) < 0.3] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["same"] = 0.1
    rows = [tuple(None if v != v and i % 2 else float(v) for i, v in enumerate(r)) for r in pdf.to_numpy()]  # NaN and null are both missing
    got = as_map(profile.corr_matrix(spark.createDataFrame(rows, "a double, b double, c double, d double, same double")))
    want = pdf.corr()
    assert len(got) == 10
    for (p, q), r in got.items():
        if "same" in (p, q):
            assert r is None
        else:
            assert abs(r - want.loc[p, q]) < 1e-9


def test_corr_matrix_side_constant_over_common_rows(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0), (4.0, None), (None, 9.0)], "a double, b double")
    assert as_map(profile.corr_matrix(df)) == {("a", "b"): None}
    assert as_map(profile.corr_matrix(df.limit(0))) == {("a", "b"): None}
    assert profile.corr_matrix(df, ["a"]).collect() == []


def test_corr_matrix_of_500_columns(spark):
    x = np.random.default_rng(4).normal(size=(40, 500))
    cols = [f"c{i}" for i in range(500)]
    wide = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").selectExpr(*[f"v[{i}] as {c}" for i, c in enumerate(cols)])
    got = as_map(profile.corr_matrix(wide))
    want = np.corrcoef(x.T)
    assert len(got) == 500 * 499 // 2
    assert max(abs(got[cols[i], cols[j]] - want[i, j]) for i, j in [(0, 1), (3, 499), (250, 251)]) < 1e-9


def test_cramers_v_with_one_class_in_most_rows(spark):
    rows = [(f"l{i % 50}", int(i % 100 == 0)) for i in range(5000)]
    got = profile.cramers_v(spark.createDataFrame(rows, "k string, y int"), ["k"], "y").first()
    table = pd.DataFrame(rows, columns=["k", "y"]).value_counts().unstack(fill_value=0).to_numpy()
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    chi2 = ((table - expected) ** 2 / expected).sum()
    assert abs(got["chi2"] - chi2) < 1e-6 and got["n_levels"] == 50
