import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanlane.operators import screen


def test_moments_of_500_columns(spark):
    k = 500
    df = spark.range(3000).select(*[(F.rand(i) + i * 1000 + (F.col("id") % 7) * (i % 3)).alias(f"c{i}") for i in range(k)])
    df = df.withColumn("c3", F.lit(5.5)).withColumn("c4", F.when(F.col("c5") % 0.5 > 0.05, F.col("c4"))).persist()
    m = screen.moment_matrix(df, df.columns)
    x = np.array(df.fillna(0.0).collect())
    want = np.cov(x.T) * (len(x) - 1)
    assert m.cross == pytest.approx(want, rel=1e-9, abs=1e-6) and m.n == 3000 and m.cross[3, 3] == 0
    none = screen.moment_matrix(df.where("false"), df.columns[:3])
    assert none.n == 0 and not none.cross.any()
    df.unpersist()


def ols(x):
    out = []
    for j in range(x.shape[1]):
        rest = np.delete(x, j, axis=1)
        left = x[:, j] - rest @ np.linalg.lstsq(rest, x[:, j], rcond=None)[0]
        out.append((x[:, j] @ x[:, j]) / (left @ left))
    return out


def test_factors_of_200_columns_and_drops_like_ols():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 200)) + rng.normal(size=(1500, 1)) * rng.random(200) * 3
    x[:, 7] = x[:, 8] + 0.05 * x[:, 7]
    x[:, 9] = x[:, 10] + 0.04 * x[:, 9] + x[:, 11]
    cols = [f"c{i}" for i in range(200)]
    m = screen.Moments(cols, len(x), x.mean(0), (x - x.mean(0)).T @ (x - x.mean(0)))
    assert list(screen.vif_scores(m, cols).values()) == pytest.approx(ols(x), rel=1e-7)
    drops = screen.drop_high_vif(m, cols, 10.0, 6)
    left = list(range(200))
    for _, c, v in drops:
        own = ols(x[:, left])
        assert v == pytest.approx(max(own), rel=1e-6) and cols[left[int(np.argmax(own))]] == c
        left.remove(cols.index(c))
    assert len(drops) >= 3


def test_columns_that_others_explain(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x = np.column_stack([x, x[:, 0] + 2 * x[:, 1], np.zeros(300)])
    cols = list("abcdez")
    m = screen.Moments(cols, 300, x.mean(0), (x - x.mean(0)).T @ (x - x.mean(0)))
    got = screen.vif_scores(m, cols)
    assert [c for c in cols if got[c] == float("inf")] == ["a", "b", "e"] and np.isnan(got["z"])
    assert got["c"] == pytest.approx(ols(x[:, :4])[2], rel=1e-6)
    assert screen.vif_scores(m, ["a"]) == {}
