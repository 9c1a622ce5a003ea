"""Cleaning operators.

``fit_*`` returns a small dict of learned settings (one aggregate job, two for
exact quantiles); ``apply_*`` is a single ``select``/``filter`` of built-in
column expressions.  Column guards follow the reference: a configured column
that is absent is skipped, never an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import INTEGRAL, NUMERIC, indicator, nan_to_null, not_in_null_true, numeric_columns
from ..functions.text import as_text, title_case, to_number, to_timestamp_or_null
from . import stats
from .profile import null_fractions


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def _replace(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Replace columns in place (keeps column order), one projection."""
    if not exprs:
        return df
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def _is_integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, INTEGRAL)


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC)


# ---------------------------------------------------------------------- F1
def fit_drop_sparse(df: DataFrame, threshold: float = 0.3, cols: Sequence[str] | None = None) -> list[str]:
    """Columns whose null fraction is strictly above ``threshold`` (one aggregate)."""
    fr = null_fractions(df, cols)
    return [c for c, f in fr.items() if f > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """F1."""
    return df.drop(*fit_drop_sparse(df, threshold))


# ---------------------------------------------------------------------- A2
def fit_impute(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, object]:
    """A2: fill value per column that has nulls: numeric -> exact median, other -> mode.

    Mode ties go to the smallest value (pandas ``mode()[0]``).  All-null columns
    get no entry.  Jobs: one null-count aggregate, one quantile job for the
    numeric columns, one grouped count for the others (pre-aggregated per
    (column, value); the winner per column is a ``min`` over (-count, value),
    so no per-column window holds a column's distinct values in one task).
    """
    df = nan_to_null(df)
    cols = list(cols or df.columns)
    fr = null_fractions(df, cols)
    with_nulls = [c for c in cols if 0.0 < fr[c] < 1.0]
    num = [c for c in with_nulls if _is_numeric(df, c)]
    other = [c for c in with_nulls if not _is_numeric(df, c)]
    fill: dict[str, object] = {}
    if num:
        qm = stats.quantile_map(df, num, [0.5])
        for c in num:
            if qm.get((c, 0.5)) is not None:
                fill[c] = qm[(c, 0.5)]
    if other:
        for r in modes(df, other).collect():
            fill[r["column"]] = r["mode"]
    return fill


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode, count) — most frequent non-null value as text, smallest on ties."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("v"))).alias("b"))
    return best.select("column", F.col("b.v").alias("mode"), (-F.col("b.neg")).alias("count"))


def apply_impute(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    """Fill nulls and NaN.  A filled integer column becomes double, whatever its median: pandas has a float column as soon as a value is missing."""
    df = nan_to_null(df, list(fill))
    exprs = {}
    for c, v in fill.items():
        if c not in df.columns:
            continue
        dt = df.schema[c].dataType
        if isinstance(dt, INTEGRAL):
            exprs[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        elif isinstance(dt, NUMERIC):
            exprs[c] = F.coalesce(F.col(c), F.lit(v).cast(dt))
        else:
            exprs[c] = F.coalesce(F.col(c), F.lit(str(v)).cast(dt))
    return _replace(df, exprs)


def impute(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return apply_impute(df, fit_impute(df, cols))


def clean_missing(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """F1 then A2 (the median/mode job runs after the drop)."""
    return impute(drop_sparse_columns(df, threshold))


# ---------------------------------------------------------------------- A3
def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """A3: whole-row (or subset) distinct; nulls compare equal.

    One shuffle on the row hash, with map-side de-duplication first, so a row
    repeated millions of times is collapsed before it moves.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


# -------------------------------------------------------------- C2 / C3
def fit_winsorize(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5, exclude: Sequence[str] = ()) -> dict[str, tuple[float, float]]:
    """{column: (lower, upper)} 1.5*IQR fences; columns with IQR <= 0 are skipped."""
    df = nan_to_null(df)
    cols = list(cols or numeric_columns(df, exclude))
    qm = stats.quantile_map(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = qm.get((c, 0.25)), qm.get((c, 0.75))
        if q1 is None or q3 is None:
            continue
        iqr = q3 - q1
        if iqr > 0:
            out[c] = (q1 - k * iqr, q3 + k * iqr)
    return out


def clip_expr(df: DataFrame, c: str, lo: float | None, hi: float | None) -> Column:
    """Clip keeping nulls (``least``/``greatest`` skip nulls); integer columns round half-even and keep their type."""
    v = F.col(c)
    x = v.cast("double")
    if lo is not None:
        x = F.greatest(x, F.lit(float(lo)))
    if hi is not None:
        x = F.least(x, F.lit(float(hi)))
    if _is_integral(df, c):
        x = F.bround(x, 0).cast(df.schema[c].dataType)
    elif not isinstance(df.schema[c].dataType, T.DoubleType):
        x = x.cast(df.schema[c].dataType)
    return F.when(v.isNull(), v).otherwise(x)


def apply_winsorize(df: DataFrame, fences: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clip to the fences; missing values (null or NaN) stay missing."""
    df = nan_to_null(df, list(fences))
    return _replace(df, {c: clip_expr(df, c, lo, hi) for c, (lo, hi) in fences.items() if c in df.columns})


def winsorize_iqr(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5, exclude: Sequence[str] = ()) -> DataFrame:
    """Mild and extreme outliers both go to the 1.5*IQR fence (net: one clip)."""
    return apply_winsorize(df, fit_winsorize(df, cols, k, exclude))


# ---------------------------------------------------------------------- C4
# The columns that the reference treats as guest counts and as counts.
GUEST_COLUMNS = ("adults", "children", "babies")
NON_NEGATIVE_COUNT_COLUMNS = (
    "previous_cancellations",
    "previous_bookings_not_canceled",
    "booking_changes",
    "days_in_waiting_list",
    "required_car_parking_spaces",
    "total_of_special_requests",
)


def columns_identical(df: DataFrame, a: str, b: str) -> bool:
    """F2 test: same type and equal in every row (nulls equal) — one aggregate."""
    if df.schema[a].dataType != df.schema[b].dataType:
        return False
    r = df.agg(F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias("eq")).first()
    return bool(r["eq"])


def drop_equal_column(df: DataFrame, a: str, b: str) -> DataFrame:
    """drop ``a`` when it duplicates ``b``."""
    if _has(df, a, b) and columns_identical(df, a, b):
        return df.drop(a)
    return df


def clamp_negative(df: DataFrame, cols: Sequence[str], to: float = 0) -> DataFrame:
    """negative values -> ``to`` (nulls kept)."""
    return _replace(df, {c: F.when(F.col(c) < 0, F.lit(to).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in cols if c in df.columns})


def fix_domain(df: DataFrame, col: str, allowed: Sequence, default) -> DataFrame:
    """values outside ``allowed`` (null included) -> ``default``."""
    if col not in df.columns:
        return df
    return _replace(df, {col: F.when(not_in_null_true(col, allowed), F.lit(default).cast(df.schema[col].dataType)).otherwise(F.col(col))})


def filter_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """keep rows with lo <= col <= hi (inclusive); nulls are dropped."""
    if col not in df.columns:
        return df
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= lo)
    if hi is not None:
        cond = cond & (F.col(col) <= hi)
    return df.where(cond)


def nullify_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F8: negative ids -> null."""
    return _replace(df, {c: F.when(F.col(c) < 0, F.lit(None)).otherwise(F.col(c)) for c in cols if c in df.columns})


def filter_non_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop rows with a negative (or null) value in any of ``cols``."""
    for c in cols:
        if c in df.columns:
            df = df.where(F.col(c) >= 0)
    return df


def filter_positive_sum(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """keep rows whose sum of ``cols`` is > 0 (a null in the sum drops the row)."""
    if not _has(df, *cols):
        return df
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return df.where(total > 0)


def repair_errors(df: DataFrame) -> DataFrame:
    """C4: the reference's error and logic fixes, in its order; only F2 runs a job."""
    df = drop_equal_column(df, "stays_in_weeks_nights", "stays_in_week_nights")
    if "Unnamed: 0" in df.columns:
        df = df.drop("Unnamed: 0")
    df = filter_positive_sum(df, GUEST_COLUMNS)
    df = clamp_negative(df, ["lead_time"])
    df = fix_domain(df, "is_repeated_guest", [0, 1], 0)
    if _has(df, "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month"):
        df = filter_range(df, "arrival_date_year", 2015, 2025)
        df = filter_range(df, "arrival_date_day_of_month", 1, 31)
    df = nullify_negative(df, ["agent", "company"])
    df = filter_range(df, "arrival_date_week_number", 1, 53)
    df = filter_range(df, "adr", None, 2000)
    df = clamp_negative(df, NON_NEGATIVE_COUNT_COLUMNS)
    df = filter_non_negative(df, GUEST_COLUMNS)
    return df


# ---------------------------------------------------------------------- C5
def _cap_expr(df: DataFrame, c: str, cap: float, cond: Column | None = None) -> Column:
    v = F.col(c)
    hit = v > F.lit(cap) if cond is None else (cond & (v > F.lit(cap)))
    if _is_integral(df, c) and float(cap) != int(cap):
        return F.when(hit, F.lit(float(cap))).otherwise(v.cast("double"))
    return F.when(hit, F.lit(cap).cast(df.schema[c].dataType)).otherwise(v)


def fit_cap_quantile_if(df: DataFrame, triggers: Mapping[str, float], q: float = 0.99) -> dict[str, float]:
    """{column: cap}: q-quantile caps for the columns whose max exceeds their trigger."""
    cols = [c for c in triggers if c in df.columns]
    if not cols:
        return {}
    df = nan_to_null(df, cols)
    mx = df.agg(*[F.max(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    hit = [c for i, c in enumerate(cols) if mx[f"m{i}"] is not None and mx[f"m{i}"] > triggers[c]]
    qm = stats.quantile_map(df, hit, [q]) if hit else {}
    return {c: qm[(c, float(q))] for c in hit if qm.get((c, float(q))) is not None}


def apply_caps(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """Cap values; missing ones stay missing.  A capped integer column becomes double if its cap has a fraction."""
    df = nan_to_null(df, list(caps))
    return _replace(df, {c: _cap_expr(df, c, cap) for c, cap in caps.items() if c in df.columns})


def cap_quantile_if(df: DataFrame, triggers: Mapping[str, float], q: float = 0.99) -> DataFrame:
    """If max(col) > trigger, cap col at its q-quantile."""
    return apply_caps(df, fit_cap_quantile_if(df, triggers, q))


# ---------------------------------------------------------------------- C6
def fit_group_infrequent(df: DataFrame, col: str, min_frac: float = 0.0005) -> list:
    """Values with count >= min_frac * rows (rows include nulls).

    At most 1/min_frac values can qualify, so the list reaching the driver is
    bounded by the parameter, not by the data.
    """
    n = df.count()
    if min_frac <= 0:
        return None  # every non-null value qualifies
    keep = (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where(F.col("cnt") >= F.lit(min_frac * n))
        .select(col)
    )
    return [r[0] for r in keep.collect()]


def apply_group_infrequent(df: DataFrame, col: str, frequent, other: str = "Other") -> DataFrame:
    if col not in df.columns:
        return df
    if frequent is None:
        return _replace(df, {col: F.coalesce(F.col(col), F.lit(other))})
    keep = F.coalesce(F.col(col).isin(list(frequent)), F.lit(False)) if frequent else F.lit(False)
    return _replace(df, {col: F.when(keep, F.col(col)).otherwise(F.lit(other))})


def group_infrequent(df: DataFrame, col: str, min_frac: float = 0.0005, other: str = "Other") -> DataFrame:
    """Infrequent values and nulls -> ``other``."""
    if col not in df.columns:
        return df
    return apply_group_infrequent(df, col, fit_group_infrequent(df, col, min_frac), other)


# ---------------------------------------------------------------------- C7
def fit_cap_by_segment(df: DataFrame, seg_col: str, segments: Sequence[str], col: str, q: float = 0.99) -> dict[str, float]:
    """{segment: cap} — exact q-quantile of ``col`` inside each listed segment present."""
    if not _has(df, seg_col, col):
        return {}
    sub = nan_to_null(df, [col]).where(F.col(seg_col).isin(list(segments)))
    rows = stats.quantiles(sub, [col], [q], by=[seg_col]).collect()
    return {r[seg_col]: r["quantile"] for r in rows}


def apply_cap_by_segment(df: DataFrame, seg_col: str, col: str, caps: Mapping[str, float]) -> DataFrame:
    if not caps or not _has(df, seg_col, col):
        return df
    df = nan_to_null(df, [col])
    v = F.col(col)
    out: Column = v
    for seg, cap in caps.items():
        out = F.when((F.col(seg_col) == seg) & (v > F.lit(cap)), F.lit(cap).cast(df.schema[col].dataType)).otherwise(out)
    return _replace(df, {col: out})


def cap_quantile_by_segment(df: DataFrame, seg_col: str, segments: Sequence[str], col: str, q: float = 0.99) -> DataFrame:
    """Cap ``col`` at its own segment's q-quantile, listed segments only."""
    return apply_cap_by_segment(df, seg_col, col, fit_cap_by_segment(df, seg_col, segments, col, q))


# ---------------------------------------------------------------------- F10
def fit_conditional_repair(df: DataFrame, predicate: Column, max_fraction: float = 0.1) -> bool:
    """True when 0 < rows matching ``predicate`` < max_fraction * rows (one aggregate)."""
    r = df.agg(F.count_if(F.coalesce(predicate, F.lit(False))).alias("a"), F.count(F.lit(1)).alias("n")).first()
    return 0 < r["a"] < max_fraction * r["n"]


def conditional_repair(df: DataFrame, predicate: Column, col: str, value, max_fraction: float = 0.1) -> DataFrame:
    """set ``col`` to ``value`` where ``predicate`` holds — only if the affected share is small."""
    if col not in df.columns or not fit_conditional_repair(df, predicate, max_fraction):
        return df
    return _replace(df, {col: F.when(F.coalesce(predicate, F.lit(False)), F.lit(value).cast(df.schema[col].dataType)).otherwise(F.col(col))})


def walk_in_deposit_rule() -> Column:
    """Rule A: lead_time == 0 and deposit_type != 'No Deposit' (a null deposit counts as different)."""
    return (F.col("lead_time") == 0) & ~F.col("deposit_type").eqNullSafe(F.lit("No Deposit"))


def repeat_guest_rule() -> Column:
    """Rule B: previous_cancellations > 0 and is_repeated_guest == 0."""
    return (F.col("previous_cancellations") > 0) & (F.col("is_repeated_guest") == 0)


BUDGET_SEGMENTS = ("Online TA", "Groups")


def context_repairs(df: DataFrame) -> DataFrame:
    """C7 on adr for budget segments, then rules A and B."""
    df = cap_quantile_by_segment(df, "market_segment", BUDGET_SEGMENTS, "adr", 0.99)
    if _has(df, "lead_time", "deposit_type"):
        df = conditional_repair(df, walk_in_deposit_rule(), "deposit_type", "No Deposit")
    if _has(df, "previous_cancellations", "is_repeated_guest"):
        df = conditional_repair(df, repeat_guest_rule(), "is_repeated_guest", 1)
    return df


# ---------------------------------------------------------------------- C9
TITLE = "title"
UPPER = "upper"
TEXT = "text"

# The reference's type-coercion lists for the bookings schema.
BOOKINGS_TYPE_SPEC = {
    "month_title": ["arrival_date_month"],
    "datetime": ["reservation_status_date"],
    "binary": ["is_repeated_guest", "is_canceled"],
    "integer": [
        "lead_time", "arrival_date_year", "arrival_date_week_number", "arrival_date_day_of_month",
        "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies",
        "previous_cancellations", "previous_bookings_not_canceled", "booking_changes",
        "days_in_waiting_list", "required_car_parking_spaces", "total_of_special_requests",
    ],
    "float": ["adr"],
    "nullable_integer": ["agent", "company"],
    "categorical": {
        "hotel": TITLE,
        "meal": UPPER,
        "country": UPPER,
        "market_segment": TEXT,
        "distribution_channel": TEXT,
        "reserved_room_type": UPPER,
        "assigned_room_type": UPPER,
        "deposit_type": TITLE,
        "customer_type": TITLE,
        "reservation_status": TITLE,
    },
}


def coerce_types(df: DataFrame, spec: Mapping = BOOKINGS_TYPE_SPEC, null_text: str | None = "nan") -> DataFrame:
    """One projection that coerces every listed column.

    * binary -> byte, integer -> long: parse as double (bad -> null), null -> 0, truncate;
    * float -> double (bad -> null); nullable integer -> half-even rounded long, nulls kept;
    * datetime -> timestamp (bad -> null);
    * categorical text: ``astype(str)`` semantics (null -> ``null_text``), then title/upper/as-is.
    """
    ex: dict[str, Column] = {}
    str_fn: dict[str, Callable[[Column], Column]] = {TITLE: title_case, UPPER: F.upper, TEXT: lambda c: c}
    for c in spec.get("month_title", []):
        if c in df.columns:
            ex[c] = title_case(as_text(F.col(c), null_text))
    for c in spec.get("datetime", []):
        if c in df.columns:
            dt = df.schema[c].dataType
            ex[c] = F.col(c).cast("timestamp") if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)) else to_timestamp_or_null(c)
    for c in spec.get("binary", []):
        if c in df.columns:
            ex[c] = F.coalesce(to_number(c), F.lit(0.0)).cast("byte")
    for c in spec.get("integer", []):
        if c in df.columns:
            ex[c] = F.coalesce(to_number(c), F.lit(0.0)).cast("long")
    for c in spec.get("float", []):
        if c in df.columns:
            ex[c] = to_number(c)
    for c in spec.get("nullable_integer", []):
        if c in df.columns:
            ex[c] = F.bround(to_number(c), 0).cast("long")
    for c, how in dict(spec.get("categorical", {})).items():
        if c in df.columns:
            ex[c] = str_fn[how](as_text(F.col(c), null_text))
    return _replace(df, ex)


def binary_flag(c: str, value) -> Column:
    """F12 re-export for convenience."""
    return indicator(F.col(c) == F.lit(value))
