"""Fitted preparation steps as ML pipeline stages.

Each step is an estimator whose ``fit`` learns its values with the batch
operators (``clean.fit_*``, ``stats``) on the frame that it is given, which is the
training part, and returns an ``SQLTransformer``: one projection of built-in
expressions with the learnt values as literals.  So a fitted pipeline, from raw
columns to the classifier, holds only stages that Spark itself saves and loads,
and works on streams as on batches.  What a stage holds is bounded by its
parameters: a value or two for each column, and at most 1 / ``min_frac`` levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC, date_columns, string_columns
from . import clean, stats


def name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def literal(v) -> str:
    """A value as an SQL literal: text, or a double."""
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({float(v)!r} AS DOUBLE)"


def replaced(exprs: dict[str, str]) -> SQLTransformer:
    """A stage that puts an expression in place of each column."""
    if not exprs:
        return SQLTransformer(statement="SELECT * FROM __THIS__")
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(map(name, exprs))}), {', '.join(f'{e} AS {name(c)}' for c, e in exprs.items())} FROM __THIS__")


def number_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (*NUMERIC, T.BooleanType)) and f.name not in set(exclude)]


class Step(Estimator):
    """A step on some columns; ``_fit`` gives the stage."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)


class Impute(Step):
    """A2: nulls and NaN become the median (numbers, which become double) or the most frequent value (text), the smallest on ties."""

    def _fit(self, df: DataFrame) -> SQLTransformer:
        numbers = [c for c in self.cols if c in set(number_columns(df))]
        texts = [c for c in self.cols if c not in numbers]
        as_double = df.select(*[F.nanvl(F.col(name(c)).cast("double"), F.lit(None).cast("double")).alias(c) for c in numbers])
        medians = stats.quantile_map(as_double, numbers, [0.5])
        common = {r["column"]: r["mode"] for r in clean.modes(df, texts).collect()} if texts else {}
        exprs = {c: f"COALESCE(NANVL(CAST({name(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), {literal(medians.get((c, 0.5)) or 0.0)})" for c in numbers}
        return replaced(exprs | {c: f"COALESCE(CAST({name(c)} AS STRING), {literal(common.get(c) or '')})" for c in texts})


class Winsorise(Step):
    """Values beyond 1.5 interquartile ranges become the fence."""

    def _fit(self, df: DataFrame) -> SQLTransformer:
        fences = clean.fit_winsorize(df, self.cols) if self.cols else {}
        return replaced({c: f"CASE WHEN {name(c)} IS NULL THEN NULL ELSE LEAST(GREATEST(CAST({name(c)} AS DOUBLE), {literal(lo)}), {literal(hi)}) END" for c, (lo, hi) in fences.items()})


class Group(Step):
    """Values of less than ``min_frac`` of the rows become ``other``, and so do nulls and values that come later."""

    def __init__(self, cols: Sequence[str], min_frac: float = 0.0005, other: str = "Other"):
        super().__init__(cols)
        self.min_frac, self.other = min_frac, other

    def _fit(self, df: DataFrame) -> SQLTransformer:
        exprs = {}
        for c in self.cols:
            kept = sorted(clean.fit_group_infrequent(df, c, self.min_frac))
            exprs[c] = f"CASE WHEN {name(c)} IN ({', '.join(map(literal, kept))}) THEN {name(c)} ELSE {literal(self.other)} END" if kept else literal(self.other)
        return replaced(exprs)


class Encode(Step):
    """The place of a value among the sorted values of at least ``min_frac`` of the rows, as a double; -1 for others."""

    def __init__(self, cols: Sequence[str], min_frac: float = 0.0005):
        super().__init__(cols)
        self.min_frac = min_frac

    def _fit(self, df: DataFrame) -> SQLTransformer:
        exprs = {}
        for c in self.cols:
            levels = sorted(clean.fit_group_infrequent(df, c, self.min_frac))
            place = f"ARRAY_POSITION(ARRAY({', '.join(map(literal, levels))}), {name(c)})" if levels else "0"
            exprs[c] = f"CAST(COALESCE({place}, 0) - 1 AS DOUBLE)"
        return replaced(exprs)


class Scale(Step):
    """(x - mean) / population deviation; a deviation of 0 counts as 1."""

    def _fit(self, df: DataFrame) -> SQLTransformer:
        if not self.cols:
            return replaced({})
        r = df.agg(*[f(F.col(name(c)).cast("double")).alias(f"{k}{i}") for i, c in enumerate(self.cols) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return replaced({c: f"(CAST({name(c)} AS DOUBLE) - {literal(r[f'm{i}'] or 0.0)}) / {literal(r[f's{i}'] or 1.0)}" for i, c in enumerate(self.cols)})


def date_parts(cols: Sequence[str]) -> SQLTransformer:
    """Year, month and day of each date, in place of it."""
    if not cols:
        return replaced({})
    made = [f"CAST({part}({name(c)}) AS DOUBLE) AS {name(f'{c}_{part.lower()}')}" for c in cols for part in ("YEAR", "MONTH", "DAY")]
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(map(name, cols))}), {', '.join(made)} FROM __THIS__")


def preparation(df: DataFrame, target: str, clf, scale: bool = False, min_frac: float = 0.0005) -> tuple[Pipeline, list[str]]:
    """A pipeline from raw rows to ``clf`` (label in ``label``), and its feature columns.

    Dates become parts; numbers are imputed and winsorised; text is imputed,
    grouped and encoded; ``scale`` standardises the numbers.  Columns of other
    types are left aside.
    """
    dates = [c for c in date_columns(df) if c != target]
    texts = [c for c in string_columns(df) if c != target]
    parts = [f"{c}_{p}" for c in dates for p in ("year", "month", "day")]
    numbers = number_columns(df, [target, "label", "weight"]) + parts
    stages = [date_parts(dates), Impute([*numbers, *texts]), Winsorise(numbers), Group(texts, min_frac), Encode(texts, min_frac)]
    if scale:
        stages.append(Scale(numbers))
    cols = [*numbers, *texts]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"), clf.setFeaturesCol("features").setLabelCol("label")]), cols
