import pytest
from pyspark.sql import functions as F

from cleanlane.operators import report
from cleanlane.plans import catalog

SF = "/root/testdata/sf0.001"
PARTS = {
    "dataset_profile_parts": {"shape", "dtypes", "nulls", "stats", "head"},
    "missing_report": {"null_pct", "pattern_sample"},
    "target_association": {"numeric", "categorical", "target_rate"},
    "collinearity_report": {"before", "after"},
    "feature_step_report": {"lead_time_hist", "requests_hist", "segments_flags", "deposit_flags", "rate_by_market_segment", "rate_by_deposit_type"},
}


@pytest.mark.parametrize("name", PARTS)
def test_a_report_query_returns_all_parts(spark, name):
    out = catalog.QUERIES[name](spark, SF)
    assert out.columns == ["part", "item", "measure", "value"]
    got = out.collect()
    assert PARTS[name] <= {r["part"] for r in got}
    assert len({(r["part"], r["item"], r["measure"]) for r in got}) == len(got)


def test_long_form_has_every_cell(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, value string")
    got = {(r["part"], r["item"], r["measure"]): r["value"] for r in report.long_form(report.missing_report(df)).collect()}
    assert got[("null_pct", "x", "null_count")] == "1" and float(got[("null_pct", "value", "null_pct")]) == pytest.approx(100 / 3)
    assert sorted(v for (p, _, m), v in got.items() if (p, m) == ("pattern_sample", "value")) == ["false", "false", "true"]
    rates = df.groupBy(F.col("value").alias("key")).count()
    assert report.long_form({"rate_by_key": rates, "none": None}).count() == 3
