"""The whole preparation flow with written stages and the reports of its run."""

import os

from pyspark.sql import functions as F

from cleanlane.operators import report
from cleanlane.plans.bookings import guest_bookings
from cleanlane.plans.pipeline import CLEAN_STAGES, fit_transform
from cleanlane.sources.io import read_stage

SF = "/root/testdata/sf0.001"


def test_fit_transform_writes_stages_and_reports(spark, tmp_path):
    # the supplied status depends on no other column, so screening drops every feature; a target that lead_time tells
    # whole would be dropped as a leak: here it is right on three rows of four
    told = (F.col("lead_time") > 90) != (F.col("booking_id") % 4 == 0)
    raw = guest_bookings(spark, SF).withColumn("is_canceled", told.cast("int")).drop("booking_id", "reservation_status")
    out, log, _ = fit_transform(raw, "is_canceled", str(tmp_path), run="first")
    assert out.columns[-1] == "is_canceled" and out.count() > 0
    assert all(os.path.isdir(tmp_path / s) for s in CLEAN_STAGES if s in {x["stage"] for x in log.frame(spark).collect()})
    repaired = read_stage(spark, str(tmp_path), "04_data_errors")
    assert "stays_in_weeks_nights" not in repaired.columns and "Unnamed: 0" not in repaired.columns
    assert repaired.where("adults + children + babies <= 0 or adults < 0 or arrival_date_week_number not between 1 and 53").count() == 0
    rows = report.read_run(spark, f"{tmp_path}/reports", "first")
    names = {r[0] for r in rows.select("report").distinct().collect()}
    assert {"shapes", "profile", "missing", "impact", "summary", "association", "ranking"} <= names, out.columns
    ranked = {r["item"] for r in rows.where("report = 'ranking' and part = 'ranking'").collect()}
    assert ranked and ranked <= set(out.columns)
    wide = {r["measure"]: r["value"] for r in rows.where(F.col("part") == "shape").collect()}
    assert wide["rows"] == str(raw.count()) and wide["columns"] == str(len(raw.columns))
