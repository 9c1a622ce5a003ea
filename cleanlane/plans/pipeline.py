"""Multi-step plans: C15 ``clean_all``, E11 ``engineer_all``, E12 ``fit_transform``.

Every stage is a fit (small aggregate jobs) plus a lazy projection.  When an
``out_dir`` on shared storage is given, each stage is written as parquet and
read back: the written table cuts the lineage (later fits do not re-run the
earlier stages) and a lost executor only recomputes from the last written
stage.  Without ``out_dir`` the plan stays lazy (tests, small data).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..functions.columns import string_columns
from ..operators import clean, features, report, screen
from ..sources.io import read_stage, write_stage

# The reference's stage names and thresholds.
CLEAN_STAGES = (
    "01_missing_values",
    "02_duplicates",
    "03_statistical_outliers",
    "04_data_errors",
    "05_infrequent_values",
    "06_context_outliers",
    "07_dtypes",
    "08_target_leakage",
    "09_multicollinearity",
)
MISSING_DROP_THRESHOLD = 0.3
CAP_TRIGGERS = {"days_in_waiting_list": 500, "lead_time": 500, "previous_cancellations": 50}
CAP_QUANTILE = 0.99
COUNTRY_MIN_FRACTION = 0.0005


@dataclass
class StageLog:
    """P3 source: (stage, rows, columns) per step, plus per-stage fit records."""

    shapes: list[tuple[str, int, int]] = field(default_factory=list)
    records: dict = field(default_factory=dict)
    cached: list = field(default_factory=list)

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.shapes, "stage string, rows long, columns int")


def _stage(df: DataFrame, name: str, log: StageLog, out_dir: str | None, count: bool) -> DataFrame:
    """End a stage: write + re-read it (out_dir), or persist it so the next stage's fits do not replay it."""
    if out_dir:
        write_stage(df, out_dir, name)
        df = read_stage(df.sparkSession, out_dir, name)
    else:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        log.cached.append(df)
    n = df.count() if (count or not out_dir) else None
    if count:
        log.shapes.append((name, n, len(df.columns)))
    # earlier cached stages are no longer read once this one is materialised
    while len(log.cached) > 1:
        log.cached.pop(0).unpersist()
    return df


def clean_all(df: DataFrame, target: str | None = "is_canceled", out_dir: str | None = None, count: bool = True) -> tuple[DataFrame, StageLog]:
    """The nine cleaning stages in the reference order (C10 skipped without the target)."""
    log = StageLog()
    if count:
        log.shapes.append(("raw", df.count(), len(df.columns)))
    dropped = clean.fit_drop_sparse(df, MISSING_DROP_THRESHOLD)
    df = df.drop(*dropped)
    fill = clean.fit_impute(df)
    log.records["missing"] = {"dropped": dropped, "filled": fill}
    df = _stage(clean.apply_impute(df, fill), CLEAN_STAGES[0], log, out_dir, count)

    df = _stage(clean.drop_duplicates(df), CLEAN_STAGES[1], log, out_dir, count)

    fences = clean.fit_winsorize(df)
    log.records["outliers"] = fences
    df = _stage(clean.apply_winsorize(df, fences), CLEAN_STAGES[2], log, out_dir, count)

    df = _stage(clean.repair_errors(df), CLEAN_STAGES[3], log, out_dir, count)

    caps = clean.fit_cap_quantile_if(df, CAP_TRIGGERS, CAP_QUANTILE)
    df = clean.apply_caps(df, caps)
    if "country" in df.columns:
        frequent = clean.fit_group_infrequent(df, "country", COUNTRY_MIN_FRACTION)
        df = clean.apply_group_infrequent(df, "country", frequent, "Other")
    log.records["infrequent"] = {"caps": caps}
    df = _stage(df, CLEAN_STAGES[4], log, out_dir, count)

    df = _stage(clean.context_repairs(df), CLEAN_STAGES[5], log, out_dir, count)

    df = _stage(clean.coerce_types(df), CLEAN_STAGES[6], log, out_dir, count)

    if target and target in df.columns:
        df, decisions = screen.screen_by_target_corr(df, target)
        log.records["leakage"] = decisions
    df = _stage(df, CLEAN_STAGES[7], log, out_dir, count)

    df, report = screen.clean_multicollinearity(df, target)
    log.records["multicollinearity"] = report
    df = _stage(df, CLEAN_STAGES[8], log, out_dir, count)
    return df, log


@dataclass
class Engineered:
    frame: DataFrame
    info: dict


def engineer_all(df: DataFrame, target: str | None = "is_canceled", scaling: str | None = "standard", encode_cols: Sequence[str] | None = None) -> Engineered:
    """E1 -> E3 -> E4 -> E5 -> E6 rooms -> E6 countries -> E7/E8 -> E9.

    E7/E8 encode the text columns the feature steps created (the reference
    encodes only plain-object columns, i.e. ``special_requests_level``) unless
    ``encode_cols`` is given.  ``info`` records the created columns and the
    scaling parameters.
    """
    before = set(df.columns)
    out = features.bucket_flags(df)
    out = features.level_from_count(out)
    out = features.market_features(out)
    out = features.deposit_features(out)
    out = features.topk_one_hot(out, "assigned_room_type", 7, "room_type")
    out = features.topk_one_hot(out, "country", 7, "country")
    if encode_cols is None:
        encode_cols = [c for c in string_columns(out) if c not in before and c != target]
    out = features.encode_categoricals(out, encode_cols)
    scale_params = None
    if scaling:
        scale_params = features.fit_scale(out, scaling, exclude=[target] if target else [])
        out = features.apply_scale(out, scale_params)
    if target and target in out.columns:
        out = out.select(*[c for c in out.columns if c != target], target)
    info = {
        "created": [c for c in out.columns if c not in before],
        "removed": sorted(before - set(out.columns)),
        "scaling": scale_params,
        "n_columns": len(out.columns),
    }
    return Engineered(out, info)


def run_reports(raw: DataFrame, cleaned: DataFrame, engineered: DataFrame, log: StageLog, target: str) -> dict:
    """The report tables of one run, as ``report.write_run`` takes them."""
    reports = {
        "shapes": log.frame(raw.sparkSession),
        "profile": report.dataset_profile(raw),
        "missing": report.missing_report(raw),
        "outliers": report.outlier_report(raw, cleaned),
        "impact": report.cleaning_impact(raw, cleaned),
        "summary": report.pipeline_summary(raw, engineered, target),
    }
    if target in raw.columns:
        reports["association"] = report.target_association(raw, target)
        reports["ranking"] = report.feature_ranking(engineered, target)
    return reports


def fit_transform(df: DataFrame, target: str = "is_canceled", out_dir: str | None = None, scaling: str = "standard", run: str | None = None) -> tuple[DataFrame, StageLog, dict]:
    """C15 then E11 with scaling.  Errors propagate (the reference swallowed them).

    With ``out_dir``, stages are written there; with ``run`` as well, the run's
    reports go to ``out_dir/reports`` (read them with ``report.read_run``).
    """
    cleaned, log = clean_all(df, target, out_dir)
    eng = engineer_all(cleaned, target, scaling)
    out = eng.frame
    if out_dir:
        write_stage(out, out_dir, "engineered")
        out = read_stage(out.sparkSession, out_dir, "engineered")
    if out_dir and run:
        report.write_run(run_reports(df, cleaned, out, log, target), f"{out_dir.rstrip('/')}/reports", run)
    return out, log, eng.info
