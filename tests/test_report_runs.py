"""Reports of a run as one table with a manifest, and box plots of a hot group."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cleanlane.operators import profile, report


def _reports(spark, n=20):
    df = spark.range(n).select((F.col("id") % 2).cast("int").alias("is_canceled"), F.col("id").cast("double").alias("x"), F.lit("a").alias("t"))
    return {
        "profile": report.dataset_profile(df),
        "association": report.target_association(df, "is_canceled"),
        "impact": report.cleaning_impact(df, df.limit(n // 2)),
    }


def test_a_run_is_read_whole_and_replaced_by_its_last_attempt(spark, tmp_path):
    out = str(tmp_path)
    report.write_run(_reports(spark, 20), out, "r1")
    report.write_run(_reports(spark, 30), out, "r2")
    rows = report.read_run(spark, out, "r1").collect()
    assert {r["report"] for r in rows} == {"profile", "association", "impact"}
    assert [r["value"] for r in rows if r["part"] == "shape" and r["measure"] == "rows"] == ["20"]
    report.write_run(_reports(spark, 40), out, "r1")
    again = report.read_run(spark, out, "r1").collect()
    assert [r["value"] for r in again if r["part"] == "shape" and r["measure"] == "rows"] == ["40"]


def test_a_failed_attempt_is_not_seen(spark, tmp_path):
    out = str(tmp_path)
    report.write_run(_reports(spark, 20), out, "r1")
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("string").alias("x"))
    with pytest.raises(Exception, match="lost"):
        report.write_run({**_reports(spark, 50), "bad": broken}, out, "r1")
    rows = report.read_run(spark, out, "r1").collect()
    assert [r["value"] for r in rows if r["part"] == "shape" and r["measure"] == "rows"] == ["20"]
    with pytest.raises(FileNotFoundError):
        report.read_run(spark, out, "r9")


def test_boxplots_with_one_group_holding_nearly_all_rows(spark):
    rng = np.random.default_rng(4)
    v = {"hot": np.where(rng.random(3000) < 0.4, 1.0, rng.standard_t(2, 3000)), "cold": rng.normal(size=30)}
    df = spark.createDataFrame([(g, float(x)) for g in v for x in v[g]], "g string, v double")
    got = {r["g"]: r for r in profile.boxplot_stats(df, ["v"], by=["g"]).collect()}
    for g, x in v.items():
        q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[g]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, med, q3))
        assert (r["whisker_low"], r["whisker_high"]) == pytest.approx((x[x >= lo].min(), x[x <= hi].max()))
        assert r["n_fliers"] == ((x < lo) | (x > hi)).sum()
