"""Generic column helpers: indicators, lookups, rounding, type families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
NUMERIC = INTEGRAL + FRACTIONAL
DATELIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def indicator(cond: Column) -> Column:
    """0/1 int of a predicate; a null predicate counts as 0 (pandas ``(s == v).astype(int)``)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def not_equal_null_true(c, value) -> Column:
    """pandas ``s != v``: a null value *satisfies* the negated test (G1)."""
    return ~_c(c).eqNullSafe(F.lit(value))


def not_in_null_true(c, values: Sequence) -> Column:
    """pandas ``~s.isin(values)``: null counts as not-in (G1)."""
    return ~F.coalesce(_c(c).isin(list(values)), F.lit(False))


def map_lookup(c, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup with default (a literal map, evaluated in codegen)."""
    if not mapping:
        return F.lit(default)
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    # try_element_at: a missing key gives null instead of an error under ANSI mode
    looked = F.try_element_at(F.create_map(*kv), _c(c))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def round_half_even(c, scale: int = 0) -> Column:
    """banker's rounding (NumPy/pandas ``round``); Spark ``round`` is half-up."""
    return F.bround(_c(c), scale)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN in float and double columns becomes null, so "missing" is one thing (as in pandas)."""
    own = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and (cols is None or f.name in cols)}
    if not own:
        return df
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in own else F.col(f"`{c}`") for c in df.columns])


def columns_of(df: DataFrame, include: tuple = NUMERIC, exclude: Sequence[str] = ()) -> list[str]:
    """column names whose Spark type is one of ``include`` (a type family)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, include) and f.name not in ex]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return columns_of(df, NUMERIC, exclude)


def integral_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return columns_of(df, INTEGRAL, exclude)


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return columns_of(df, (T.StringType,), exclude)


def date_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return columns_of(df, DATELIKE, exclude)


def boolean_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return columns_of(df, (T.BooleanType,), exclude)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def safe_name(name: str) -> str:
    """Column-name fragment from a data value: lower-case, non-alphanumerics -> '_'."""
    out = []
    for ch in str(name).lower():
        out.append(ch if ch.isalnum() else "_")
    s = "".join(out).strip("_")
    while "__" in s:
        s = s.replace("__", "_")
    return s or "blank"
