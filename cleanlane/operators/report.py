"""Profile and report tables (P1–P13): the data behind the reference's plots and routes.

Every report is a set of small DataFrames built from the profiling
aggregates; nothing is rendered.  Column-name driven pieces (type counts,
feature categories) are schema metadata and stay on the driver.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns, string_columns
from . import profile

# The reference's feature-category keywords and correlation tiers.
FEATURE_CATEGORIES = {
    "Temporal": ("lead_time", "advance", "last_minute"),
    "Market Segment": ("market_segment",),
    "Deposit": ("deposit",),
    "Customer Behavior": ("special", "requirements"),
    "Room": ("room",),
    "Country": ("country",),
}
HIGH_TIER = 0.3
MEDIUM_TIER = 0.1


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def long_form(parts: Mapping[str, DataFrame | None]) -> DataFrame:
    """All parts of a report as (part, item, measure, value), a row per cell.

    ``item``: the column(s), bucket, value or group that a row is about, or the
    row's number in a part of plain rows; values are strings, null cells stay.
    """

    def melted(name: str, part: DataFrame) -> DataFrame:
        plain = name in ("head", "pattern_sample")
        keys = [] if plain else [c for c in part.columns if c in ("column", "col_a", "col_b", "bucket", "value") or name == f"rate_by_{c}"]
        item = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]) if keys else F.monotonically_increasing_id().cast("string")
        cells = [F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").cast("string").alias("value")) for c in part.columns if c not in keys]
        return part.select(item.alias("item"), F.array(*cells).alias("cells")).select(F.lit(name).alias("part"), "item", F.inline("cells"))

    return reduce(DataFrame.unionByName, [melted(n, p) for n, p in parts.items() if p is not None])


# ---------------------------------------------------------------- S6 / S9
def run_parts(reports: Mapping[str, Mapping[str, DataFrame | None] | DataFrame]) -> DataFrame:
    """The reports of one run as one table (report, part, item, measure, value).

    A report is a mapping of parts or one table, which becomes the part ``table``.
    """
    long = [long_form(r if isinstance(r, Mapping) else {"table": r}).select(F.lit(name).alias("report"), "*") for name, r in reports.items()]
    return reduce(DataFrame.unionByName, long)


def write_run(reports: Mapping, out_dir: str, run: str) -> str:
    """Write all reports of ``run`` to ``out_dir``; readers see all of them or none.

    The rows go to one table partitioned by run, attempt and report, each attempt
    into folders of its own.  Only when all are there, one file is added to the
    manifest that names the attempt and its rows per report, so an attempt that
    failed, or is under way, is never read.  Writing a run again replaces it for
    readers.  Returns the attempt.
    """
    attempt = uuid.uuid4().hex
    rows = run_parts(reports)
    spark = _spark(rows)
    tagged = rows.select(F.lit(run).alias("run"), F.lit(attempt).alias("attempt"), "*")
    tagged.write.mode("append").partitionBy("run", "attempt", "report").parquet(f"{out_dir}/parts")
    counts = {r["report"]: r["count"] for r in _attempt(spark, out_dir, attempt).groupBy("report").count().collect()}
    entry = spark.createDataFrame([(run, attempt, name, counts.get(name, 0)) for name in reports], "run string, attempt string, report string, rows long")
    entry.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{out_dir}/manifest")
    return attempt


_RUN_SCHEMA = "part string, item string, measure string, value string, run string, attempt string, report string"


def _attempt(spark: SparkSession, out_dir: str, attempt: str) -> DataFrame:
    return spark.read.schema(_RUN_SCHEMA).parquet(f"{out_dir}/parts").where(F.col("attempt") == attempt)


def read_run(spark: SparkSession, out_dir: str, run: str) -> DataFrame:
    """The rows (report, part, item, measure, value) of the last complete attempt of ``run``.

    An error if no attempt is complete or rows of it are missing.
    """
    entries = spark.read.parquet(f"{out_dir}/manifest").where(F.col("run") == run)
    last = entries.orderBy(F.col("written_at").desc(), "attempt").select("attempt").first()
    if last is None:
        raise FileNotFoundError(f"no complete run {run} in {out_dir}")
    rows = _attempt(spark, out_dir, last["attempt"])
    wanted = entries.where(F.col("attempt") == last["attempt"]).agg(F.sum("rows")).first()[0]
    found = rows.count()
    if found != wanted:
        raise RuntimeError(f"run {run} has {found} of {wanted} rows")
    return rows.select("report", "part", "item", "measure", "value")


# ---------------------------------------------------------------- P1 / P2
def dataset_profile(df: DataFrame, head: int = 5) -> dict[str, DataFrame]:
    """Shape, dtypes, nulls per column (zeros included), describe, first rows."""
    spark = _spark(df)
    rows, cols = shape(df)
    return {
        "shape": spark.createDataFrame([(rows, cols)], "rows long, columns int"),
        "dtypes": spark.createDataFrame(df.dtypes, "column string, type string"),
        "nulls": profile.null_profile(df, nonzero_only=False),
        "stats": profile.describe(df),
        "head": df.limit(head),
    }


def preview(df: DataFrame, n: int = 50) -> tuple[DataFrame, tuple[int, int]]:
    """The first n rows and the shape."""
    return df.limit(n), shape(df)


# ---------------------------------------------------------------------- P3
def stage_shapes(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, rows, columns) for named frames (one count per stage)."""
    spark = _spark(stages[0][1])
    return spark.createDataFrame([(n, d.count(), len(d.columns)) for n, d in stages], "stage string, rows long, columns int")


# ---------------------------------------------------------------------- P4
def missing_report(df: DataFrame, sample_rows: int = 1000, seed: int = 42) -> dict[str, DataFrame]:
    """Null percentages (non-zero, desc) and a seeded random sample of the null pattern.

    The sample is a top-n by a seeded random key: each task keeps n rows, so
    the sample never gathers more than n rows per task.
    """
    pattern = df.orderBy(F.rand(seed)).limit(sample_rows).select(*[F.col(c).isNull().alias(c) for c in df.columns])
    return {"null_pct": profile.null_profile(df), "pattern_sample": pattern}


# ---------------------------------------------------------------------- P5
def outlier_report(before: DataFrame, after: DataFrame, top: int = 6) -> DataFrame:
    """P5: columns whose IQR outlier count or non-null count changed, top ``top`` by reduction."""
    cols = [c for c in numeric_columns(before) if c in after.columns]
    b = profile.outlier_counts(before, cols).select("column", F.col("n_outliers").alias("outliers_before"))
    a = profile.outlier_counts(after, cols).select("column", F.col("n_outliers").alias("outliers_after"))
    nb = profile.null_profile(before, cols, nonzero_only=False).select("column", F.col("null_count").alias("nulls_before"))
    na = profile.null_profile(after, cols, nonzero_only=False).select("column", F.col("null_count").alias("nulls_after"))
    rb, ra = before.count(), after.count()
    j = b.join(a, "column").join(nb, "column").join(na, "column")
    j = j.select(
        "column",
        "outliers_before",
        "outliers_after",
        (F.lit(rb) - F.col("nulls_before")).alias("non_null_before"),
        (F.lit(ra) - F.col("nulls_after")).alias("non_null_after"),
    )
    changed = (F.col("outliers_before") != F.col("outliers_after")) | (F.col("non_null_before") != F.col("non_null_after"))
    return j.where(changed).orderBy((F.col("outliers_before") - F.col("outliers_after")).desc(), "column").limit(top)


# ---------------------------------------------------------------------- P6
def dtype_counts(df: DataFrame) -> Counter:
    return Counter(t for _, t in df.dtypes)


def dtype_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Number of columns per type, before and after."""
    b, a = dtype_counts(before), dtype_counts(after)
    rows = [(t, b.get(t, 0), a.get(t, 0)) for t in sorted(set(b) | set(a))]
    return _spark(before).createDataFrame(rows, "type string, before int, after int")


# ---------------------------------------------------------------------- P7
def target_association(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """Pearson r for numeric columns, Cramér's V for text columns, the target rate."""
    num = [c for c in numeric_columns(df) if c != target]
    cat = [c for c in string_columns(df) if c != target]
    out = {"numeric": profile.corr_with_target(df, num, target) if num else None}
    out["categorical"] = profile.cramers_v(df, cat, target).orderBy(F.col("cramers_v").desc_nulls_last()) if cat else None
    out["target_rate"] = df.agg(F.avg(F.col(target).cast("double")).alias("rate"), F.count(target).alias("n"))
    return out


# ---------------------------------------------------------------------- P8
def collinearity_report(before: DataFrame, after: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """Lower-triangle correlation matrices of the numeric columns before and after."""
    ex = [target] if target else []
    return {
        "before": profile.corr_matrix(before, numeric_columns(before, ex)),
        "after": profile.corr_matrix(after, numeric_columns(after, ex)),
    }


# ---------------------------------------------------------------------- P9
def total_nulls(df: DataFrame) -> int:
    if not df.columns:
        return 0
    return int(df.agg(sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))).first()[0])


def cleaning_impact(raw: DataFrame, final: DataFrame) -> DataFrame:
    """rows/columns removed, missing values fixed, row reduction %."""
    rr, rc = shape(raw)
    fr, fc = shape(final)
    rm, fm = total_nulls(raw), total_nulls(final)
    rows = [
        ("Rows Removed", float(rr - fr)),
        ("Columns Removed", float(rc - fc)),
        ("Missing Values Fixed", float(rm - fm)),
        ("Data Reduction (%)", (rr - fr) / rr * 100.0 if rr else 0.0),
    ]
    return _spark(raw).createDataFrame(rows, "metric string, value double")


# --------------------------------------------------------------------- P10
def feature_step_report(original: DataFrame, transformed: DataFrame, target: str | None = "is_canceled") -> dict[str, DataFrame]:
    """P10: lead-time histogram, flag totals per feature group, risk counts, target rate by segment/deposit."""
    out: dict[str, DataFrame] = {}
    if "lead_time" in original.columns:
        out["lead_time_hist"] = profile.histogram(original, "lead_time", 50)
    if "total_of_special_requests" in original.columns:
        out["requests_hist"] = profile.unit_histogram(original, "total_of_special_requests")
    groups = {
        "temporal": [c for c in transformed.columns if any(k in c for k in ("lead_time", "advance", "last_minute", "normal")) and c != "lead_time_risk_score"],
        "behavior": [c for c in transformed.columns if "special" in c or "requirements" in c],
        "segments": [c for c in transformed.columns if c.startswith("market_segment_")],
        "deposit": [c for c in transformed.columns if c.startswith("has_") and "deposit" in c],
        "deposit_risk": [c for c in transformed.columns if c.startswith("deposit_risk_")],
    }
    for name, cols in groups.items():
        cols = [c for c in cols if c in numeric_columns(transformed)]
        if cols:
            out[f"{name}_flags"] = profile.indicator_sums(transformed, cols)
    if target and target in original.columns:
        for key in ("market_segment", "deposit_type"):
            if key in original.columns:
                out[f"rate_by_{key}"] = profile.rate_by_group(original, key, target)
    return out


# --------------------------------------------------------------------- P11
def scaling_report(before: DataFrame, after: DataFrame, target: str | None = "is_canceled", max_cols: int = 6) -> DataFrame:
    """Mean and sample std before/after for the first ``max_cols`` numeric columns."""
    cols = [c for c in numeric_columns(before) if c != target and c in after.columns][:max_cols]
    b = profile.scalar_stats(before, cols).select("column", F.col("mean").alias("mean_before"), F.col("std").alias("std_before"))
    a = profile.scalar_stats(after, cols).select("column", F.col("mean").alias("mean_after"), F.col("std").alias("std_after"))
    return b.join(a, "column")


# --------------------------------------------------------------------- P12
def feature_ranking(df: DataFrame, target: str = "is_canceled", top: int = 20) -> dict[str, DataFrame]:
    """|r| with the target (tiers High > 0.3, Medium > 0.1, Low) and the top features' matrix."""
    r = profile.corr_with_target(df, [c for c in numeric_columns(df) if c != target], target)
    tier = F.when(F.col("abs_correlation") > HIGH_TIER, "High").when(F.col("abs_correlation") > MEDIUM_TIER, "Medium").otherwise("Low")
    ranked = r.withColumn("tier", tier).orderBy(F.col("abs_correlation").desc_nulls_last(), "column").limit(top)
    names = [x["column"] for x in ranked.select("column").collect()]
    return {"ranking": ranked, "matrix": profile.corr_matrix(df, names + [target])}


# --------------------------------------------------------------------- P13
def feature_categories(columns: Sequence[str]) -> dict[str, int]:
    """Column counts per feature category by name keywords; 'Other' for the rest; zero categories dropped."""
    out = {name: sum(1 for c in columns if any(k in c for k in keys)) for name, keys in FEATURE_CATEGORIES.items()}
    all_keys = [k for keys in FEATURE_CATEGORIES.values() for k in keys]
    out["Other"] = sum(1 for c in columns if not any(k in c for k in all_keys))
    return {k: v for k, v in out.items() if v > 0}


def pipeline_summary(original: DataFrame, final: DataFrame, target: str = "is_canceled") -> DataFrame:
    """(section, item, value): feature categories, totals, completeness %, strongly correlated count."""
    spark = _spark(final)
    rows: list[tuple[str, str, float]] = []
    for k, v in feature_categories(final.columns).items():
        rows.append(("category", k, float(v)))
    orow, ocol = shape(original)
    frow, fcol = shape(final)
    rows += [("totals", "original_columns", float(ocol)), ("totals", "final_columns", float(fcol)), ("totals", "rows", float(frow))]
    om, fm = total_nulls(original), total_nulls(final)
    cells = frow * fcol
    rows += [("quality", "missing_original", float(om)), ("quality", "missing_final", float(fm))]
    rows.append(("quality", "completeness_pct", (cells - fm) / cells * 100.0 if cells else 0.0))
    if target in final.columns:
        r = profile.corr_with_target(final, [c for c in numeric_columns(final) if c != target], target)
        rows.append(("correlation", "features_abs_r_above_0.3", float(r.where(F.col("abs_correlation") > HIGH_TIER).count())))
    for t, n in sorted(dtype_counts(final).items()):
        rows.append(("types", t, float(n)))
    return spark.createDataFrame(rows, "section string, item string, value double")
