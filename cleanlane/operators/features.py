"""Feature operators.

Data-dependent *column names* (top-k levels, one-hot levels) need one small
action that returns the levels; after that every step is a projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import indicator, map_lookup, nan_to_null
from ..functions.text import as_text
from . import stats

# Lead-time buckets, segment and deposit vocabularies of the reference.
LEAD_TIME_EDGES = (7, 90)
LEAD_TIME_FLAGS = ("is_last_minute_lead_time", "is_normal_lead_time", "is_advance_lead_time")
LEAD_TIME_WEIGHTS = (3, 2, 1)

SEGMENT_CATEGORY = {
    "Online TA": "online_ta",
    "Offline TA/TO": "offline_ta_to",
    "Groups": "groups",
    "Direct": "direct",
    "Corporate": "corporate",
}
SEGMENT_CATEGORIES = ("online_ta", "offline_ta_to", "groups", "direct", "corporate", "other")
SEGMENT_RISK = {
    "Groups": "High",
    "Offline TA/TO": "Medium",
    "Online TA": "Medium",
    "Corporate": "Low",
    "Direct": "Low",
}
DEPOSIT_RISK = {"No Deposit": "High", "Refundable": "Medium", "Non Refund": "Low"}


def _drop_then_add(df: DataFrame, drop: Sequence[str], new: Sequence[Column]) -> DataFrame:
    keep = [F.col(c) for c in df.columns if c not in set(drop)]
    return df.select(*keep, *new)


# ------------------------------------------------------------------ E1 / E2
def bucket_flag_columns(col: str, edges: Sequence[float], names: Sequence[str]) -> list[Column]:
    """0/1 flags for (-inf, e0], (e0, e1], …, (e_last, inf); null -> all 0."""
    v = F.col(col)
    bounds = [None, *edges, None]
    out = []
    for i, name in enumerate(names):
        lo, hi = bounds[i], bounds[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (v > lo)
        if hi is not None:
            cond = cond & (v <= hi)
        out.append(indicator(cond).alias(name))
    return out


def bucket_flags(
    df: DataFrame,
    col: str = "lead_time",
    edges: Sequence[float] = LEAD_TIME_EDGES,
    names: Sequence[str] = LEAD_TIME_FLAGS,
    weights: Sequence[int] | None = LEAD_TIME_WEIGHTS,
    score_name: str = "lead_time_risk_score",
    drop_source: bool = True,
) -> DataFrame:
    """E1 + E2: bucket flags and a weighted risk score, source dropped."""
    if col not in df.columns:
        return df
    flags = bucket_flag_columns(col, edges, names)
    new = list(flags)
    if weights is not None:
        score = None
        for f, w in zip(flags, weights):
            term = f * F.lit(w)
            score = term if score is None else score + term
        new.append(score.alias(score_name))
    return _drop_then_add(df, [col] if drop_source else [], new)


# ---------------------------------------------------------------------- E3
def level_from_count(
    df: DataFrame,
    col: str = "total_of_special_requests",
    flag_name: str = "has_special_requirements",
    level_name: str = "special_requests_level",
) -> DataFrame:
    """Flag (>0) and level: 0 None, <=1 Low, <=3 Medium, else High (null -> High, as NumPy's where)."""
    if col not in df.columns:
        return df
    v = F.col(col)
    level = F.when(v == 0, "None").when(v <= 1, "Low").when(v <= 3, "Medium").otherwise("High")
    return _drop_then_add(df, [col], [indicator(v > 0).alias(flag_name), level.alias(level_name)])


# ---------------------------------------------------------------------- E4
def market_features(df: DataFrame, col: str = "market_segment") -> DataFrame:
    """Six segment flags and three risk flags (unknown segment -> other / Medium)."""
    if col not in df.columns:
        return df
    s = as_text(F.col(col))
    cat = map_lookup(s, SEGMENT_CATEGORY, "other")
    risk = map_lookup(s, SEGMENT_RISK, "Medium")
    new = [indicator(cat == c).alias(f"market_segment_{c}") for c in SEGMENT_CATEGORIES]
    new += [indicator(risk == r).alias(f"{r.lower()}_risk_segment") for r in ("High", "Medium", "Low")]
    return _drop_then_add(df, [col], new)


# ---------------------------------------------------------------------- E5
def deposit_features(df: DataFrame, col: str = "deposit_type") -> DataFrame:
    """E5: has/refundable/non-refund flags and High/Medium/Low risk flags (unknown -> Medium)."""
    if col not in df.columns:
        return df
    s = as_text(F.col(col))
    risk = map_lookup(s, DEPOSIT_RISK, "Medium")
    new = [
        indicator(s != "No Deposit").alias("has_deposit"),
        indicator(s == "Refundable").alias("has_refundable_deposit"),
        indicator(s == "Non Refund").alias("has_non_refund_deposit"),
        indicator(risk == "High").alias("deposit_risk_high"),
        indicator(risk == "Medium").alias("deposit_risk_medium"),
        indicator(risk == "Low").alias("deposit_risk_low"),
    ]
    return _drop_then_add(df, [col], new)


# ---------------------------------------------------------------------- E6
def fit_top_levels(df: DataFrame, col: str, k: int = 7) -> list[str]:
    """The k most frequent text values (null counts as the text ``nan``), ties by value asc."""
    s = as_text(F.col(col))
    top = df.groupBy(s.alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("v")).limit(k)
    return [r["v"] for r in top.collect()]


def apply_top_levels(df: DataFrame, col: str, levels: Sequence[str], prefix: str) -> DataFrame:
    """One flag per level plus ``{prefix}_other``.

    Spark resolves names case-insensitively, so a level whose flag name equals
    ``{prefix}_other`` up to case (e.g. ``OTHER``) is folded into the other
    flag, and later case-equal duplicates are folded into the first (G2).
    """
    s = as_text(F.col(col))
    other_name = f"{prefix}_other"
    flags: dict[str, list[str]] = {}
    folded: list[str] = []
    for lv in levels:
        name = f"{prefix}_{lv}"
        if name.lower() == other_name.lower():
            folded.append(lv)
            continue
        key = next((n for n in flags if n.lower() == name.lower()), name)
        flags.setdefault(key, []).append(lv)
    new = [indicator(s.isin(v)).alias(n) for n, v in flags.items()]
    in_top = s.isin(list(levels)) if levels else F.lit(False)
    other = ~in_top | (s.isin(folded) if folded else F.lit(False))
    new.append(indicator(other).alias(other_name))
    return _drop_then_add(df, [col], new)


def topk_one_hot(df: DataFrame, col: str, k: int = 7, prefix: str | None = None) -> DataFrame:
    """Flags for the k most frequent values + ``_other``; source dropped."""
    if col not in df.columns:
        return df
    return apply_top_levels(df, col, fit_top_levels(df, col, k), prefix or col)


# ------------------------------------------------------------------ E7 / E8
MAX_LEVELS = 1000


def fit_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list | None]:
    """Sorted distinct non-null levels per column, one grouped job for all columns.

    The levels become column names, so what reaches the driver is bounded:
    a column of more than ``max_levels`` levels gets None (it is encoded into
    one sparse vector instead).
    """
    cols = list(cols)
    if not cols:
        return {}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    pairs = df.select(F.inline(cells)).where(F.col("level").isNotNull()).distinct()
    # at most max_levels + 1 of the sorted levels of each column
    first = pairs.withColumn("i", F.row_number().over(Window.partitionBy("column").orderBy("level"))).where(F.col("i") <= max_levels + 1)
    out: dict[str, list] = {c: [] for c in cols}
    for r in first.collect():
        out[r["column"]].append(r["level"])
    return {c: sorted(v) if len(v) <= max_levels else None for c, v in out.items()}


def level_names(col: str, levels: Sequence[str]) -> list[str]:
    """``{col}_{level}`` for each level; names that differ in case only (one name to Spark) are numbered from the second on."""
    seen: dict[str, int] = {}
    out = []
    for level in levels:
        name = f"{col}_{level}"
        seen[name.lower()] = seen.get(name.lower(), 0) + 1
        out.append(name if seen[name.lower()] == 1 else f"{name}__{seen[name.lower()]}")
    return out


def dummies(col: str, levels: Sequence[str], skip: int = 0) -> list[Column]:
    names = level_names(col, levels)
    return [indicator(F.col(col).cast("string") == level).alias(name) for name, level in list(zip(names, levels))[skip:]]


def binary_code(col: str, levels: Sequence[str], has_null: bool) -> Column:
    """Place of the value among the sorted classes; a null is the class ``nan`` of its own (text encoding before sorting)."""
    classes = sorted([*levels, "nan"]) if has_null else list(levels)
    text = as_text(F.col(col)) if has_null else F.col(col).cast("string")
    out = F.lit(None).cast("long")
    for i, level in reversed(list(enumerate(classes))):
        out = F.when(text == level, F.lit(i).cast("long")).otherwise(out)
    return out


def wide_one_hot(df: DataFrame, col: str) -> DataFrame:
    """E8 for a column with very many levels: one sparse vector ``{col}_onehot`` over the sorted levels, first one and null all zero."""
    from pyspark.ml.feature import OneHotEncoder

    coded = category_codes(df, col, "_code")
    top = coded.agg(F.max("_code")).first()[0]
    # the encoder leaves out its last category: count levels downwards, null with the first level
    coded = coded.withColumn("_place", F.when(F.col("_code") < 0, F.lit(top)).otherwise(F.lit(top) - F.col("_code")).cast("double"))
    made = OneHotEncoder(inputCols=["_place"], outputCols=[f"{col}_onehot"]).fit(coded).transform(coded)
    return made.drop(col, "_code", "_place")


def encode_categoricals(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> DataFrame:
    """E7 + E8: two-level columns -> class codes in sorted order; others -> one-hot minus the first level.

    Null rows get 0 in every dummy; in a label-encoded column a null is a class
    of its own (``nan``), so codes go up to 2 there.  Columns with more than
    ``max_levels`` levels become one sparse vector.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    levels = fit_levels(df, cols, max_levels)
    wide = [c for c in cols if levels[c] is None]
    binary = [c for c in cols if levels[c] is not None and len(levels[c]) == 2]
    nulls = df.agg(*[F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(f"n{i}") for i, c in enumerate(binary)]).first() if binary else ()
    replaced = {c: binary_code(c, levels[c], nulls[i]) for i, c in enumerate(binary)}
    new = [x for c in cols if c not in replaced and c not in wide for x in dummies(c, levels[c], 1)]
    keep = [replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns if c in replaced or c in wide or c not in set(cols)]
    out = df.select(*keep, *new)
    for c in wide:
        out = wide_one_hot(out, c)
    return out


def one_hot(df: DataFrame, col: str, drop_first: bool = True) -> DataFrame:
    """E8 alone: sorted levels -> ``{col}_{level}`` 0/1 columns (first dropped), source dropped."""
    levels = fit_levels(df, [col])[col]
    if levels is None:
        return wide_one_hot(df, col)
    return _drop_then_add(df, [col], dummies(col, levels, int(drop_first)))


# ---------------------------------------------------------------------- W6
#: Sampled values, and every so many of them a cut between ranges of a vocabulary.
CODE_SAMPLE, CODE_STEP = 4096, 16


def category_codes(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Dense code of the value in sorted order (0-based), null -> -1.

    The vocabulary (distinct values) is cut into ranges at values of a bounded
    sample (its smallest hashes), each range is ranked by itself behind the
    counts of the ranges before, and the ranks are joined back; the planner
    picks the join by size, and adaptive execution splits a hot value.
    """
    name = name or col
    vocab = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    sample = sorted(r["_v"] for r in vocab.orderBy(F.xxhash64("_v"), "_v").limit(CODE_SAMPLE).collect())
    cuts = sample[CODE_STEP::CODE_STEP]
    part = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x <= F.col("_v"))) if cuts else F.lit(0)
    vocab = vocab.withColumn("_part", part)
    sizes = {r["_part"]: r["count"] for r in vocab.groupBy("_part").count().collect()}  # a row for each range
    before = [sum(n for p, n in sizes.items() if p < i) for i in range(len(cuts) + 1)]
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_v"))
    ranked = vocab.withColumn("_rank", rank).select("_v", (F.element_at(F.array(*[F.lit(x).cast("long") for x in before]), F.col("_part") + 1) + F.col("_rank") - 1).alias("_code"))
    out = df.join(ranked, df[col].eqNullSafe(ranked["_v"]), "left")
    code = F.coalesce(F.col("_code"), F.lit(-1)).cast("int")
    cols = [code.alias(name) if (c == col and name == col) else F.col(c) for c in df.columns]
    if name != col:
        cols.append(code.alias(name))
    return out.select(*cols)


# ---------------------------------------------------------------------- E9
SCALABLE_TYPES = (T.LongType, T.DoubleType)


def fit_scale(df: DataFrame, method: str = "standard", exclude: Sequence[str] = ("is_canceled",), cols: Sequence[str] | None = None) -> dict:
    """Scaling parameters {column: (center, scale)} for columns that need scaling.

    Candidates are 64-bit integer and double columns (the reference selects
    int64/float64 only) with range > 10 or max > 100.  ``standard`` uses the
    population std (G4), ``minmax`` the range, ``robust`` the IQR around the
    median; a zero scale becomes 1.  Unknown methods fall back to standard.
    """
    df = nan_to_null(df)
    if method not in ("standard", "minmax", "robust"):
        method = "standard"
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, SCALABLE_TYPES) and f.name not in set(exclude)]
    cols = list(cols)
    if not cols:
        return {"method": method, "params": {}}
    r = df.agg(
        *[
            x
            for i, c in enumerate(cols)
            for x in (
                F.min(F.col(c).cast("double")).alias(f"mn{i}"),
                F.max(F.col(c).cast("double")).alias(f"mx{i}"),
                F.avg(F.col(c).cast("double")).alias(f"mu{i}"),
                F.stddev_pop(F.col(c).cast("double")).alias(f"sd{i}"),
            )
        ]
    ).first()
    chosen = [
        (i, c)
        for i, c in enumerate(cols)
        if r[f"mx{i}"] is not None and ((r[f"mx{i}"] - r[f"mn{i}"]) > 10 or r[f"mx{i}"] > 100)
    ]
    params: dict[str, tuple[float, float]] = {}
    if method == "robust" and chosen:
        qm = stats.quantile_map(df, [c for _, c in chosen], [0.25, 0.5, 0.75])
    for i, c in chosen:
        if method == "standard":
            center, scale = r[f"mu{i}"], r[f"sd{i}"]
        elif method == "minmax":
            center, scale = r[f"mn{i}"], r[f"mx{i}"] - r[f"mn{i}"]
        else:
            center, scale = qm[(c, 0.5)], qm[(c, 0.75)] - qm[(c, 0.25)]
        params[c] = (float(center), float(scale) if scale else 1.0)
    return {"method": method, "params": params}


def apply_scale(df: DataFrame, fitted: Mapping) -> DataFrame:
    p = fitted["params"]
    df = nan_to_null(df, list(p))
    return df.select(
        *[((F.col(c).cast("double") - F.lit(p[c][0])) / F.lit(p[c][1])).alias(c) if c in p else F.col(c) for c in df.columns]
    )


def scale(df: DataFrame, method: str = "standard", exclude: Sequence[str] = ("is_canceled",)) -> DataFrame:
    """E9."""
    return apply_scale(df, fit_scale(df, method, exclude))


# ---------------------------------------------------------------------- J1
def isin_frequent(df: DataFrame, col: str, frequent: DataFrame, flag: str = "in_frequent") -> DataFrame:
    """Membership flag of ``col`` in a computed key set (null counts as not-in).

    The planner picks the join by the key set's size in bytes.
    """
    keys = frequent.select(F.col(frequent.columns[0]).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    out = df.join(keys, df[col] == keys["_k"], "left")
    return out.select(*[F.col(c) for c in df.columns], F.coalesce(F.col("_hit"), F.lit(False)).cast("int").alias(flag))
