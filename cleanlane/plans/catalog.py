"""Driver query catalogue: one Spark query per operator plus its DuckDB oracle.

Each query takes ``(spark, sf_dir)``, reads the supplied tables (or the
bookings-shaped view Spark derives from them) in full, and returns a
DataFrame.  ``ORACLES[name]`` is ANSI SQL over the same tables with identical
column names and types.  Computed doubles are rounded (6 places) on both sides
because Spark's summation order is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, evaluate, features, profile, screen, stats
from ..sources.io import table
from .bookings import BOOKINGS_VIEW_SQL, GUEST_BOOKINGS_SQL, bookings_view, guest_bookings

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def R(c, digits: int = DIGITS):
    """Round a computed double for hashing."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def bview(body: str) -> str:
    """Oracle SQL with the bookings view as CTE ``bv``."""
    return f"WITH bv AS ({BOOKINGS_VIEW_SQL})\n{body}"


# =============================================================== step 0 slice
@query(
    "winsorize_rate_by_priority",
    """
WITH b AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
w AS (
  SELECT o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_canceled,
         CASE WHEN q3 - q1 > 0 THEN least(greatest(o_totalprice, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))
              ELSE o_totalprice END AS price_w
  FROM orders CROSS JOIN b)
SELECT o_orderpriority, count(is_canceled) AS count, CAST(sum(is_canceled) AS BIGINT) AS sum,
       round(avg(is_canceled), 6) AS mean, round(avg(price_w), 6) AS avg_price_w
FROM w GROUP BY o_orderpriority
""",
)
def q_winsorize_rate_by_priority(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderpriority", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_canceled"), "o_totalprice"
    )
    w = clean.winsorize_iqr(o, ["o_totalprice"])
    return w.groupBy("o_orderpriority").agg(
        F.count("is_canceled").alias("count"),
        F.sum(F.col("is_canceled").cast("long")).alias("sum"),
        R(F.avg("is_canceled")).alias("mean"),
        R(F.avg("o_totalprice")).alias("avg_price_w"),
    )


# ============================================================== step 1 profiles
_NULLY_ORDERS_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price,
       nullif(o_orderpriority, '1-URGENT') AS priority,
       CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS odate
FROM orders"""


def _nully_orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("odate"),
    )


@query(
    "null_profile",
    f"""
WITH t AS ({_NULLY_ORDERS_SQL}),
u AS (
  SELECT 'o_orderkey' AS "column", CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) AS null_count, count(*) AS n FROM t
  UNION ALL SELECT 'price', count(*) FILTER (WHERE price IS NULL), count(*) FROM t
  UNION ALL SELECT 'priority', count(*) FILTER (WHERE priority IS NULL), count(*) FROM t
  UNION ALL SELECT 'status', count(*) FILTER (WHERE status IS NULL), count(*) FROM t
  UNION ALL SELECT 'odate', count(*) FILTER (WHERE odate IS NULL), count(*) FROM t)
SELECT "column", null_count, round(null_count * 100.0 / n, 6) AS null_pct FROM u WHERE null_count > 0
""",
)
def q_null_profile(spark, sf):
    p = profile.null_profile(_nully_orders(spark, sf))
    return p.select("column", "null_count", R("null_pct").alias("null_pct"))


@query(
    "drop_sparse",
    f"""
WITH t AS ({_NULLY_ORDERS_SQL}),
u AS (
  SELECT 'o_orderkey' AS "column", avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END) AS f FROM t
  UNION ALL SELECT 'price', avg(CASE WHEN price IS NULL THEN 1.0 ELSE 0.0 END) FROM t
  UNION ALL SELECT 'priority', avg(CASE WHEN priority IS NULL THEN 1.0 ELSE 0.0 END) FROM t
  UNION ALL SELECT 'status', avg(CASE WHEN status IS NULL THEN 1.0 ELSE 0.0 END) FROM t
  UNION ALL SELECT 'odate', avg(CASE WHEN odate IS NULL THEN 1.0 ELSE 0.0 END) FROM t)
SELECT "column", round(f, 6) AS null_fraction, f > 0.3 AS dropped FROM u
""",
)
def q_drop_sparse(spark, sf):
    t = _nully_orders(spark, sf)
    fr = profile.null_fractions(t)
    dropped = set(clean.fit_drop_sparse(t, 0.3))
    kept = clean.drop_sparse_columns(t, 0.3).columns
    assert set(kept) == set(t.columns) - dropped
    rows = [(c, float(f), c in dropped) for c, f in fr.items()]
    return spark.createDataFrame(rows, "column string, null_fraction double, dropped boolean").select(
        "column", R("null_fraction").alias("null_fraction"), "dropped"
    )


@query(
    "describe",
    """
WITH u AS (
  SELECT 'l_quantity' AS "column", count(l_quantity) AS count, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS std,
         min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50,
         quantile_cont(l_quantity, 0.75) AS q75, max(l_quantity) AS max FROM lineitem
  UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), avg(l_extendedprice), stddev_samp(l_extendedprice), min(l_extendedprice),
         quantile_cont(l_extendedprice, 0.25), quantile_cont(l_extendedprice, 0.5), quantile_cont(l_extendedprice, 0.75), max(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', count(l_discount), avg(l_discount), stddev_samp(l_discount), min(l_discount),
         quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75), max(l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', count(l_tax), avg(l_tax), stddev_samp(l_tax), min(l_tax),
         quantile_cont(l_tax, 0.25), quantile_cont(l_tax, 0.5), quantile_cont(l_tax, 0.75), max(l_tax) FROM lineitem)
SELECT "column", count, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, round(q25, 6) AS q25,
       round(q50, 6) AS q50, round(q75, 6) AS q75, round(max, 6) AS max FROM u
""",
)
def q_describe(spark, sf):
    d = profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return d.select("column", "count", *[R(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


_PROBS = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


@query(
    "quantiles",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 6) AS quantile FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
        for p in _PROBS
    ),
)
def q_quantiles(spark, sf):
    q = profile.quantile_table(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], _PROBS)
    return q.select("column", "prob", R("quantile").alias("quantile"))


@query(
    "value_counts",
    """
SELECT l_returnflag AS value, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS fraction
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
""",
)
def q_value_counts(spark, sf):
    v = profile.value_counts(table(spark, sf, "lineitem"), "l_returnflag", normalize=True)
    return v.select("value", "count", R("fraction").alias("fraction"))


@query(
    "nunique",
    """
SELECT 'l_returnflag' AS "column", count(DISTINCT l_returnflag) AS n_unique FROM lineitem
UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem
UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem
""",
)
def q_nunique(spark, sf):
    return profile.nunique(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey", "l_quantity"])


@query(
    "scalar_stats",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean, "
        f"round(sum({c}), 6) AS sum, round(stddev_samp({c}), 6) AS std, round(var_samp({c}), 6) AS var FROM events"
        for c in ("value", "user_id")
    ),
)
def q_scalar_stats(spark, sf):
    s = profile.scalar_stats(table(spark, sf, "events"), ["value", "user_id"])
    return s.select("column", *[R(c).alias(c) for c in ("min", "max", "mean", "sum", "std", "var")])


@query(
    "rate_by_group",
    bview(
        """
SELECT market_segment, count(is_canceled) AS count, CAST(sum(is_canceled) AS BIGINT) AS sum, round(avg(is_canceled), 6) AS mean
FROM bv WHERE market_segment IS NOT NULL GROUP BY market_segment
"""
    ),
)
def q_rate_by_group(spark, sf):
    r = profile.rate_by_group(bookings_view(spark, sf), "market_segment", "is_canceled")
    return r.select("market_segment", "count", "sum", R("mean").alias("mean"))


@query(
    "class_balance",
    bview(
        """
SELECT is_canceled AS label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS fraction
FROM bv WHERE is_canceled IS NOT NULL GROUP BY is_canceled
"""
    ),
)
def q_class_balance(spark, sf):
    c = profile.class_balance(bookings_view(spark, sf), "is_canceled")
    return c.select("label", "count", R("fraction").alias("fraction"))


@query(
    "histogram",
    """
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(greatest(CAST(floor(20.0 * (value - lo) / (hi - lo)) AS BIGINT) + 1, 1), 20) AS bucket, lo, hi
      FROM events CROSS JOIN r WHERE value IS NOT NULL)
SELECT CAST(bucket AS INTEGER) AS bucket, round(lo + (bucket - 1) * ((hi - lo) / 20.0), 6) AS lower,
       round(lo + bucket * ((hi - lo) / 20.0), 6) AS upper, count(*) AS count
FROM b GROUP BY bucket, lo, hi
""",
)
def q_histogram(spark, sf):
    h = profile.histogram(table(spark, sf, "events"), "value", 20)
    return h.select("bucket", R("lower").alias("lower"), R("upper").alias("upper"), "count")


@query(
    "boxplot_stats",
    """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.event_type, 'value' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(CASE WHEN value >= lo_f THEN value END), 6) AS whisker_low,
       round(max(CASE WHEN value <= hi_f THEN value END), 6) AS whisker_high,
       count(*) FILTER (WHERE value < lo_f OR value > hi_f) AS n_fliers
FROM events e JOIN f ON e.event_type = f.event_type
GROUP BY f.event_type, q1, median, q3
""",
)
def q_boxplot_stats(spark, sf):
    b = profile.boxplot_stats(table(spark, sf, "events"), ["value"], by=["event_type"])
    return b.select("event_type", "column", *[R(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "n_fliers")


@query(
    "outlier_counts",
    """
WITH q AS (
  SELECT 'value' AS "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
  UNION ALL SELECT 'user_id', quantile_cont(user_id, 0.25), quantile_cont(user_id, 0.75) FROM events),
c AS (
  SELECT 'value' AS "column",
         count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers,
         count(*) FILTER (WHERE value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)) AS n_extreme
  FROM events CROSS JOIN (SELECT * FROM q WHERE "column" = 'value') qq
  UNION ALL
  SELECT 'user_id',
         count(*) FILTER (WHERE user_id < q1 - 1.5 * (q3 - q1) OR user_id > q3 + 1.5 * (q3 - q1)),
         count(*) FILTER (WHERE user_id < q1 - 3 * (q3 - q1) OR user_id > q3 + 3 * (q3 - q1))
  FROM events CROSS JOIN (SELECT * FROM q WHERE "column" = 'user_id') qq)
SELECT q."column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
       n_outliers, n_extreme, n_outliers - n_extreme AS n_mild
FROM q JOIN c ON q."column" = c."column"
""",
)
def q_outlier_counts(spark, sf):
    o = profile.outlier_counts(table(spark, sf, "events"), ["value", "user_id"])
    return o.select("column", *[R(c).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")], "n_outliers", "n_extreme", "n_mild")


@query(
    "indicator_sums",
    bview(
        """
SELECT 'is_canceled' AS "column", CAST(sum(is_canceled) AS BIGINT) AS ones FROM bv
UNION ALL SELECT 'is_repeated_guest', CAST(sum(is_repeated_guest) AS BIGINT) FROM bv
"""
    ),
)
def q_indicator_sums(spark, sf):
    return profile.indicator_sums(bookings_view(spark, sf), ["is_canceled", "is_repeated_guest"])


# ============================================================== step 2 cleaning
_LI_NULLY_SQL = """
SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS disc,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS flag
FROM lineitem"""


@query(
    "impute_median_mode",
    f"""
WITH t AS ({_LI_NULLY_SQL}),
m AS (SELECT quantile_cont(disc, 0.5) AS md FROM t),
mo AS (SELECT flag AS mf FROM t WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
SELECT l_orderkey, l_linenumber, round(coalesce(disc, md), 6) AS disc, coalesce(flag, mf) AS flag
FROM t CROSS JOIN m CROSS JOIN mo
""",
)
def q_impute_median_mode(spark, sf):
    li = table(spark, sf, "lineitem")
    t = li.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"),
        F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
    )
    out = clean.clean_missing(t, threshold=0.3)
    return out.select("l_orderkey", "l_linenumber", R("disc").alias("disc"), "flag")


@query("dedup_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def q_dedup_rows(spark, sf):
    return clean.drop_duplicates(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@query(
    "winsorize_iqr",
    """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id,
       round(CASE WHEN value IS NULL OR q3 - q1 <= 0 THEN value
                  ELSE least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) END, 6) AS value
FROM events CROSS JOIN b
""",
)
def q_winsorize_iqr(spark, sf):
    w = clean.winsorize_iqr(table(spark, sf, "events").select("event_id", "value"), ["value"])
    return w.select("event_id", R("value").alias("value"))


@query(
    "winsorize_iqr_int",
    bview(
        """
, b AS (SELECT quantile_cont(lead_time, 0.25) AS q1, quantile_cont(lead_time, 0.75) AS q3 FROM bv)
SELECT booking_id,
       CAST(round_even(least(greatest(lead_time, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 0) AS BIGINT) AS lead_time
FROM bv CROSS JOIN b
"""
    ).replace(")\n, b AS", "), b AS", 1),
)
def q_winsorize_iqr_int(spark, sf):
    w = clean.winsorize_iqr(bookings_view(spark, sf).select("booking_id", "lead_time"), ["lead_time"])
    return w


_REPAIR_OUT = ("booking_id", "lead_time", "is_repeated_guest", "agent", "previous_cancellations", "total_of_special_requests")


@query(
    "repair_errors",
    bview(
        """
SELECT booking_id,
       CASE WHEN lead_time < 0 THEN 0 ELSE lead_time END AS lead_time,
       CASE WHEN coalesce(is_repeated_guest IN (0, 1), false) THEN is_repeated_guest ELSE 0 END AS is_repeated_guest,
       CASE WHEN agent < 0 THEN NULL ELSE agent END AS agent,
       CASE WHEN previous_cancellations < 0 THEN 0 ELSE previous_cancellations END AS previous_cancellations,
       CASE WHEN total_of_special_requests < 0 THEN 0 ELSE total_of_special_requests END AS total_of_special_requests,
       round(adr, 6) AS adr
FROM bv WHERE adr <= 2000
"""
    ),
)
def q_repair_errors(spark, sf):
    r = clean.repair_errors(bookings_view(spark, sf))
    return r.select(*_REPAIR_OUT, R("adr").alias("adr"))


@query(
    "conditional_repair",
    bview(
        """
, a AS (SELECT count(*) FILTER (WHERE lead_time = 0 AND deposit_type IS DISTINCT FROM 'No Deposit') AS na,
               count(*) FILTER (WHERE previous_cancellations > 0 AND is_repeated_guest = 0) AS nb,
               count(*) AS n FROM bv)
SELECT booking_id,
       CASE WHEN na > 0 AND na < 0.1 * n AND lead_time = 0 AND deposit_type IS DISTINCT FROM 'No Deposit'
            THEN 'No Deposit' ELSE deposit_type END AS deposit_type,
       CASE WHEN nb > 0 AND nb < 0.1 * n AND previous_cancellations > 0 AND is_repeated_guest = 0
            THEN 1 ELSE is_repeated_guest END AS is_repeated_guest
FROM bv CROSS JOIN a
"""
    ).replace(")\n, a AS", "), a AS", 1),
)
def q_conditional_repair(spark, sf):
    b = bookings_view(spark, sf)
    b = clean.conditional_repair(b, clean.walk_in_deposit_rule(), "deposit_type", "No Deposit")
    b = clean.conditional_repair(b, clean.repeat_guest_rule(), "is_repeated_guest", 1)
    return b.select("booking_id", "deposit_type", "is_repeated_guest")


def gview(body: str) -> str:
    """Oracle SQL with the bookings view as CTE ``bv`` and its wide form as ``g``."""
    return f"WITH bv AS ({BOOKINGS_VIEW_SQL}), g AS ({GUEST_BOOKINGS_SQL})\n{body}"


@query(
    "repair_guests_and_dates",
    gview(
        """
SELECT * EXCLUDE ("Unnamed: 0", stays_in_weeks_nights)
       REPLACE (CASE WHEN lead_time < 0 THEN 0 ELSE lead_time END AS lead_time,
                CASE WHEN coalesce(is_repeated_guest IN (0, 1), false) THEN is_repeated_guest ELSE 0 END AS is_repeated_guest,
                CASE WHEN agent < 0 THEN NULL ELSE agent END AS agent,
                round(adr, 6) AS adr)
FROM g
WHERE adults + children + babies > 0 AND adults >= 0 AND children >= 0 AND babies >= 0
  AND arrival_date_year BETWEEN 2015 AND 2025 AND arrival_date_day_of_month BETWEEN 1 AND 31
  AND arrival_date_week_number BETWEEN 1 AND 53 AND adr <= 2000
"""
    ),
)
def q_repair_guests_and_dates(spark, sf):
    """C4 with F2, F3, F4, F7 and F9: the wide bookings lose their duplicate and index columns and impossible rows."""
    return clean.repair_errors(guest_bookings(spark, sf)).withColumn("adr", R("adr"))


@query(
    "context_repairs",
    gview(
        """
, a AS (SELECT count(*) FILTER (WHERE lead_time = 0 AND deposit_type IS DISTINCT FROM 'No Deposit') AS na,
               count(*) FILTER (WHERE previous_cancellations > 0 AND is_repeated_guest = 0) AS nb,
               count(*) AS n FROM g),
q AS (SELECT market_segment AS seg, quantile_cont(adr, 0.99) AS cap FROM g
      WHERE market_segment IN ('Online TA', 'Groups') GROUP BY market_segment)
SELECT booking_id, round(CASE WHEN cap IS NOT NULL AND adr > cap THEN cap ELSE adr END, 9) AS adr,
       CASE WHEN na > 0 AND na < 0.1 * n AND lead_time = 0 AND deposit_type IS DISTINCT FROM 'No Deposit'
            THEN 'No Deposit' ELSE deposit_type END AS deposit_type,
       CASE WHEN nb > 0 AND nb < 0.1 * n AND previous_cancellations > 0 AND is_repeated_guest = 0
            THEN 1 ELSE is_repeated_guest END AS is_repeated_guest
FROM g CROSS JOIN a LEFT JOIN q ON market_segment = seg
"""
    ).replace(")\n\n, a AS", "), a AS", 1),
)
def q_context_repairs(spark, sf):
    """Caps by segment, then the two conditional rules."""
    return clean.context_repairs(guest_bookings(spark, sf)).select("booking_id", R("adr", 9).alias("adr"), "deposit_type", "is_repeated_guest")


@query(
    "stage_shapes",
    gview(
        """
SELECT 'raw' AS stage, count(*) AS rows, 24 AS columns FROM g
UNION ALL
SELECT 'repaired', count(*), 22 FROM g
WHERE adults + children + babies > 0 AND adults >= 0 AND children >= 0 AND babies >= 0
  AND arrival_date_year BETWEEN 2015 AND 2025 AND arrival_date_day_of_month BETWEEN 1 AND 31
  AND arrival_date_week_number BETWEEN 1 AND 53 AND adr <= 2000
"""
    ),
)
def q_stage_shapes(spark, sf):
    """Shapes of the wide bookings before and after the repairs."""
    from ..operators import report

    raw = guest_bookings(spark, sf)
    return report.stage_shapes([("raw", raw), ("repaired", clean.repair_errors(raw))])


@query(
    "cap_q99_if",
    """
WITH m AS (SELECT max(value) AS mv, quantile_cont(value, 0.99) AS qv, max(user_id) AS mu, quantile_cont(user_id, 0.99) AS qu FROM events)
SELECT event_id,
       round(CASE WHEN mv > 300 AND value > qv THEN qv ELSE value END, 6) AS value,
       CASE WHEN mu > 500 AND user_id > qu THEN CAST(qu AS BIGINT) ELSE user_id END AS user_id
FROM events CROSS JOIN m
""",
)
def q_cap_q99_if(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value", "user_id")
    c = clean.cap_quantile_if(e, {"value": 300, "user_id": 500}, 0.99)
    return c.select("event_id", R("value").alias("value"), "user_id")


@query(
    "cap_q99_by_segment",
    """
WITH q AS (SELECT event_type, quantile_cont(value, 0.99) AS cap FROM events WHERE event_type IN ('click', 'view') GROUP BY event_type)
SELECT e.event_id, e.event_type, round(CASE WHEN q.cap IS NOT NULL AND e.value > q.cap THEN q.cap ELSE e.value END, 6) AS value
FROM events e LEFT JOIN q ON e.event_type = q.event_type
""",
)
def q_cap_q99_by_segment(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    c = clean.cap_quantile_by_segment(e, "event_type", ["click", "view"], "value", 0.99)
    return c.select("event_id", "event_type", R("value").alias("value"))


@query(
    "group_infrequent",
    """
WITH t AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_grouped FROM events),
f AS (SELECT user_grouped AS u FROM t WHERE user_grouped IS NOT NULL GROUP BY user_grouped
      HAVING count(*) >= 0.005 * (SELECT count(*) FROM t))
SELECT event_id, CASE WHEN user_grouped IN (SELECT u FROM f) THEN user_grouped ELSE 'Other' END AS user_grouped FROM t
""",
)
def q_group_infrequent(spark, sf):
    t = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("user_grouped"))
    return clean.group_infrequent(t, "user_grouped", 0.005, "Other")


_RAW_ORDERS_SQL = """
SELECT o_orderkey,
       lower(monthname(o_orderdate)) AS month_raw,
       CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS flag_raw,
       CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE CAST(o_custkey * 3 + 0.5 AS VARCHAR) END AS int_raw,
       o_totalprice / 100 AS agent_raw,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE lower(o_orderstatus) END AS status_raw,
       lower(o_orderpriority) || '-ta/to' AS kind_raw,
       CASE WHEN o_orderkey % 9 = 0 THEN 'not a date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_raw
FROM orders"""

_RAW_SPEC = {
    "month_title": ["month_raw"],
    "datetime": ["date_raw"],
    "binary": ["flag_raw"],
    "integer": ["int_raw"],
    "nullable_integer": ["agent_raw"],
    "categorical": {"status_raw": clean.UPPER, "kind_raw": clean.TITLE},
}


def _title_sql(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '([[:alpha:]]+|[^[:alpha:]]+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


@query(
    "coerce_types",
    f"""
WITH t AS ({_RAW_ORDERS_SQL})
SELECT o_orderkey,
       {_title_sql("month_raw")} AS month_raw,
       CAST(coalesce(TRY_CAST(flag_raw AS DOUBLE), 0) AS TINYINT) AS flag_raw,
       CAST(trunc(coalesce(TRY_CAST(int_raw AS DOUBLE), 0)) AS BIGINT) AS int_raw,
       CAST(round_even(agent_raw, 0) AS BIGINT) AS agent_raw,
       upper(coalesce(status_raw, 'nan')) AS status_raw,
       {_title_sql("kind_raw")} AS kind_raw,
       CAST(TRY_CAST(date_raw AS TIMESTAMP) AS DATE) AS date_raw
FROM t
""",
)
def q_coerce_types(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        "o_orderkey",
        F.lower(F.date_format("o_orderdate", "MMMM")).alias("month_raw"),
        F.when(k % 5 == 0, F.lit("x")).otherwise((k % 3).cast("string")).alias("flag_raw"),
        F.when(k % 7 == 0, F.lit("bad")).otherwise((F.col("o_custkey") * 3 + 0.5).cast("string")).alias("int_raw"),
        (F.col("o_totalprice") / 100).alias("agent_raw"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.lower("o_orderstatus")).alias("status_raw"),
        F.concat(F.lower("o_orderpriority"), F.lit("-ta/to")).alias("kind_raw"),
        F.when(k % 9 == 0, F.lit("not a date")).otherwise(F.to_date("o_orderdate").cast("string")).alias("date_raw"),
    )
    c = clean.coerce_types(raw, _RAW_SPEC)
    return c.withColumn("date_raw", F.to_date("date_raw"))


# ========================================================== step 3 dates
def _date_oracle(level: str) -> str:
    d = "CAST(o_orderdate AS DATE)"
    parts = [
        f"CAST(year({d}) AS INTEGER) AS o_orderdate_year",
        f"CAST(month({d}) AS INTEGER) AS o_orderdate_month",
        f"CAST(day({d}) AS INTEGER) AS o_orderdate_day",
        f"CAST(isodow({d}) - 1 AS INTEGER) AS o_orderdate_dayofweek",
    ]
    m_sin = f"round(sin(2 * pi() * month({d}) / 12.0), 6) AS o_orderdate_month_sin"
    m_cos = f"round(cos(2 * pi() * month({d}) / 12.0), 6) AS o_orderdate_month_cos"
    d_sin = f"round(sin(2 * pi() * (isodow({d}) - 1) / 7.0), 6) AS o_orderdate_dayofweek_sin"
    d_cos = f"round(cos(2 * pi() * (isodow({d}) - 1) / 7.0), 6) AS o_orderdate_dayofweek_cos"
    weekend = f"CAST(isodow({d}) >= 6 AS INTEGER) AS o_orderdate_is_weekend"
    if level == "basic":
        cols = parts + [weekend, m_sin, m_cos, d_sin, d_cos]
    else:
        cols = parts + [
            f"CAST(quarter({d}) AS INTEGER) AS o_orderdate_quarter",
            weekend,
            f"CAST(day({d}) = 1 AS INTEGER) AS o_orderdate_is_month_start",
            f"CAST({d} = last_day({d}) AS INTEGER) AS o_orderdate_is_month_end",
            f"CASE WHEN month({d}) IN (12, 1, 2) THEN 1 WHEN month({d}) IN (3, 4, 5) THEN 2 "
            f"WHEN month({d}) IN (6, 7, 8) THEN 3 ELSE 4 END AS o_orderdate_season",
            f"CAST(month({d}) IN (6, 7, 8, 12) AS INTEGER) AS o_orderdate_is_peak_season",
            f"CAST(month({d}) IN (12, 1, 7, 8) AS INTEGER) AS o_orderdate_is_holiday_season",
            m_sin,
            m_cos,
            d_sin,
            d_cos,
            f"CAST(date_diff('day', DATE '2015-01-01', {d}) AS INTEGER) AS o_orderdate_days_since_ref",
            f"CAST(dayofyear({d}) AS INTEGER) AS o_orderdate_day_of_year",
            f"CAST(week({d}) AS INTEGER) AS o_orderdate_week_of_year",
        ]
    return "SELECT o_orderkey, " + ",\n       ".join(cols) + "\nFROM orders"


def _dates_query(level: str):
    def fn(spark, sf):
        from ..functions.dates import date_features

        o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
        out = date_features(o, ["o_orderdate"], level=level)
        return out.select(*[R(c).alias(c) if c.endswith(("_sin", "_cos")) else F.col(c) for c in out.columns])

    return fn


query("date_features_basic", _date_oracle("basic"))(_dates_query("basic"))
query("date_features_full", _date_oracle("full"))(_dates_query("full"))


# ========================================================= step 4 features
@query(
    "bucket_flags",
    bview(
        """
SELECT booking_id,
       CAST(coalesce(lead_time <= 7, false) AS INTEGER) AS is_last_minute_lead_time,
       CAST(coalesce(lead_time > 7 AND lead_time <= 90, false) AS INTEGER) AS is_normal_lead_time,
       CAST(coalesce(lead_time > 90, false) AS INTEGER) AS is_advance_lead_time,
       3 * CAST(coalesce(lead_time <= 7, false) AS INTEGER) + 2 * CAST(coalesce(lead_time > 7 AND lead_time <= 90, false) AS INTEGER)
         + CAST(coalesce(lead_time > 90, false) AS INTEGER) AS lead_time_risk_score
FROM bv
"""
    ),
)
def q_bucket_flags(spark, sf):
    b = bookings_view(spark, sf).select("booking_id", "lead_time")
    return features.bucket_flags(b)


@query(
    "level_from_count",
    bview(
        """
SELECT booking_id,
       CAST(coalesce(total_of_special_requests > 0, false) AS INTEGER) AS has_special_requirements,
       CASE WHEN total_of_special_requests = 0 THEN 'None' WHEN total_of_special_requests <= 1 THEN 'Low'
            WHEN total_of_special_requests <= 3 THEN 'Medium' ELSE 'High' END AS special_requests_level
FROM bv
"""
    ),
)
def q_level_from_count(spark, sf):
    return features.level_from_count(bookings_view(spark, sf).select("booking_id", "total_of_special_requests"))


_SEG_CAT = (
    "CASE coalesce(market_segment, 'nan') WHEN 'Online TA' THEN 'online_ta' WHEN 'Offline TA/TO' THEN 'offline_ta_to' "
    "WHEN 'Groups' THEN 'groups' WHEN 'Direct' THEN 'direct' WHEN 'Corporate' THEN 'corporate' ELSE 'other' END"
)
_SEG_RISK = (
    "CASE coalesce(market_segment, 'nan') WHEN 'Groups' THEN 'High' WHEN 'Offline TA/TO' THEN 'Medium' WHEN 'Online TA' THEN 'Medium' "
    "WHEN 'Corporate' THEN 'Low' WHEN 'Direct' THEN 'Low' ELSE 'Medium' END"
)
_DEP = "coalesce(deposit_type, 'nan')"
_DEP_RISK = f"CASE {_DEP} WHEN 'No Deposit' THEN 'High' WHEN 'Refundable' THEN 'Medium' WHEN 'Non Refund' THEN 'Low' ELSE 'Medium' END"


@query(
    "map_flags",
    bview(
        "SELECT booking_id,\n"
        + ",\n".join(
            [f"CAST({_SEG_CAT} = '{c}' AS INTEGER) AS market_segment_{c}" for c in features.SEGMENT_CATEGORIES]
            + [f"CAST({_SEG_RISK} = '{r}' AS INTEGER) AS {r.lower()}_risk_segment" for r in ("High", "Medium", "Low")]
            + [
                f"CAST({_DEP} <> 'No Deposit' AS INTEGER) AS has_deposit",
                f"CAST({_DEP} = 'Refundable' AS INTEGER) AS has_refundable_deposit",
                f"CAST({_DEP} = 'Non Refund' AS INTEGER) AS has_non_refund_deposit",
            ]
            + [f"CAST({_DEP_RISK} = '{r}' AS INTEGER) AS deposit_risk_{r.lower()}" for r in ("High", "Medium", "Low")]
        )
        + "\nFROM bv"
    ),
)
def q_map_flags(spark, sf):
    b = bookings_view(spark, sf).select("booking_id", "market_segment", "deposit_type")
    return features.deposit_features(features.market_features(b))


@query(
    "topk_one_hot",
    """
WITH t AS (SELECT c_custkey, coalesce(CAST(c_nationkey AS VARCHAR), 'nan') AS v FROM customer),
top AS (SELECT v FROM t GROUP BY v ORDER BY count(*) DESC, v LIMIT 7)
SELECT c_custkey, CASE WHEN t.v IN (SELECT v FROM top) THEN 'nation_' || t.v ELSE 'nation_other' END AS flags
FROM t
""",
)
def q_topk_one_hot(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    out = features.topk_one_hot(c, "nation", 7)
    flag_cols = [x for x in out.columns if x.startswith("nation_")]
    # the raised flags of each row, comma-joined (exactly one for this encoding)
    raised = F.array_join(F.array_sort(F.filter(F.array(*[F.when(F.col(x) == 1, F.lit(x)) for x in flag_cols]), lambda v: v.isNotNull())), ",")
    return out.select("c_custkey", raised.alias("flags"))


@query(
    "one_hot_drop_first",
    """
WITH lv AS (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL),
first AS (SELECT min(p_type) AS f FROM lv)
SELECT p_partkey, CASE WHEN p_type IS NULL OR p_type = (SELECT f FROM first) THEN NULL ELSE 'p_type_' || p_type END AS flag,
       (SELECT count(*) - 1 FROM lv) AS n_dummies
FROM part
""",
)
def q_one_hot_drop_first(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    out = features.one_hot(p, "p_type")
    dummies = [c for c in out.columns if c.startswith("p_type_")]
    flag = F.lit(None).cast("string")
    for d in dummies:
        flag = F.when(F.col(d) == 1, F.lit(d)).otherwise(flag)
    return out.select("p_partkey", flag.alias("flag"), F.lit(len(dummies)).cast("long").alias("n_dummies"))


@query(
    "label_encode",
    """
SELECT l_orderkey, l_linenumber,
       CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS BIGINT) AS l_linestatus
FROM lineitem
""",
)
def q_label_encode(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return features.encode_categoricals(li, ["l_linestatus"])


@query(
    "category_codes",
    """
WITH v AS (SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority IS NOT NULL),
r AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM v)
SELECT o_orderkey, coalesce(r.code, -1) AS o_orderpriority
FROM orders LEFT JOIN r ON orders.o_orderpriority = r.v
""",
)
def q_category_codes(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return features.category_codes(o, "o_orderpriority")


def _scale_oracle(method: str) -> str:
    cols = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    if method == "standard":
        stats_sql = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in cols)
    elif method == "minmax":
        stats_sql = ", ".join(f"min({c}) AS c_{c}, max({c}) - min({c}) AS s_{c}, min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in cols)
    else:
        stats_sql = ", ".join(
            f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}, min({c}) AS mn_{c}, max({c}) AS mx_{c}"
            for c in cols
        )
    sel = ", ".join(
        f"round(CASE WHEN mx_{c} - mn_{c} > 10 OR mx_{c} > 100 THEN ({c} - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END ELSE {c} END, 6) AS {c}"
        for c in cols
    )
    return f"WITH s AS (SELECT {stats_sql} FROM lineitem)\nSELECT l_orderkey, l_linenumber, {sel}\nFROM lineitem CROSS JOIN s"


def _scale_query(method: str):
    def fn(spark, sf):
        li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
        fitted = features.fit_scale(li, method, exclude=("l_orderkey", "l_linenumber"))
        out = features.apply_scale(li, fitted)
        return out.select("l_orderkey", "l_linenumber", *[R(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")])

    return fn


for _m in ("standard", "minmax", "robust"):
    query(f"scale_{_m}", _scale_oracle(_m))(_scale_query(_m))


# ============================================================ step 5 screening
@query(
    "crosstab",
    """
SELECT o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_canceled, count(*) AS count
FROM orders GROUP BY ALL
""",
)
def q_crosstab(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_canceled"))
    return profile.crosstab(o, "o_orderpriority", "is_canceled")


_CV_COLS = ("market_segment", "deposit_type", "assigned_room_type", "country", "parity")


@query(
    "cramers_v",
    bview(
        """
, t AS (SELECT *, CASE WHEN booking_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM bv),
long AS (
  SELECT 'market_segment' AS col, market_segment AS level, is_canceled AS y FROM t
  UNION ALL SELECT 'deposit_type', deposit_type, is_canceled FROM t
  UNION ALL SELECT 'assigned_room_type', assigned_room_type, is_canceled FROM t
  UNION ALL SELECT 'country', country, is_canceled FROM t
  UNION ALL SELECT 'parity', parity, is_canceled FROM t),
obs AS (SELECT col, level, CAST(y AS VARCHAR) AS y, count(*) AS o FROM long WHERE level IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
lv AS (SELECT DISTINCT col, level FROM obs),
ys AS (SELECT DISTINCT col, y FROM obs),
grid AS (SELECT lv.col, lv.level, ys.y, coalesce(obs.o, 0) AS o
         FROM lv JOIN ys ON lv.col = ys.col LEFT JOIN obs ON obs.col = lv.col AND obs.level = lv.level AND obs.y = ys.y),
e AS (SELECT *, sum(o) OVER (PARTITION BY col, level) * sum(o) OVER (PARTITION BY col, y) / sum(o) OVER (PARTITION BY col) AS ex,
             sum(o) OVER (PARTITION BY col) AS n FROM grid),
shape AS (SELECT col, count(DISTINCT level) AS nl, count(DISTINCT y) AS nc FROM grid GROUP BY col),
cells AS (SELECT e.*, nl, nc,
                 CASE WHEN nl = 2 AND nc = 2 THEN o + sign(ex - o) * least(0.5, abs(ex - o)) ELSE o END AS oc
          FROM e JOIN shape USING (col)),
chi AS (SELECT col, max(n) AS n, max(nl) AS nl, max(nc) AS nc, sum((oc - ex) * (oc - ex) / ex) AS chi2 FROM cells GROUP BY col)
SELECT col AS "column", CAST(n AS BIGINT) AS n, nl AS n_levels, round(chi2, 6) AS chi2,
       round(CASE WHEN least(nl, nc) > 1 THEN sqrt(chi2 / (n * (least(nl, nc) - 1))) END, 6) AS cramers_v
FROM chi
"""
    ).replace(")\n, t AS", "), t AS", 1),
)
def q_cramers_v(spark, sf):
    b = bookings_view(spark, sf).withColumn("parity", F.when(F.col("booking_id") % 2 == 0, "even").otherwise("odd"))
    v = profile.cramers_v(b, _CV_COLS, "is_canceled")
    return v.select("column", "n", "n_levels", R("chi2").alias("chi2"), R("cramers_v").alias("cramers_v"))


_NUM_BV = ("lead_time", "total_of_special_requests", "is_repeated_guest", "previous_cancellations", "agent", "adr")


@query(
    "corr_with_target",
    bview(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", round(corr({c}, is_canceled), 6) AS correlation, round(abs(corr({c}, is_canceled)), 6) AS abs_correlation FROM bv"
            for c in _NUM_BV
        )
    ),
)
def q_corr_with_target(spark, sf):
    r = profile.corr_with_target(bookings_view(spark, sf), list(_NUM_BV), "is_canceled")
    return r.select("column", R("correlation").alias("correlation"), R("abs_correlation").alias("abs_correlation"))


_LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query(
    "corr_matrix",
    "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
        for i, a in enumerate(_LI_NUM)
        for b in _LI_NUM[i + 1 :]
    ),
)
def q_corr_matrix(spark, sf):
    m = profile.corr_matrix(table(spark, sf, "lineitem"), list(_LI_NUM))
    return m.select("col_a", "col_b", R("correlation").alias("correlation"))


_SCREEN_NUM = ("booking_id", "lead_time", "total_of_special_requests", "is_repeated_guest", "previous_cancellations", "agent", "adr")
_SCREEN_CAT = ("country", "market_segment", "deposit_type", "assigned_room_type")


def _screen_oracle() -> str:
    num = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col, 'numeric' AS type, corr(coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(quantile_cont({c}, 0.5), 0) FROM bv)), CAST(is_canceled AS DOUBLE)) AS r, "
        f"CAST(NULL AS VARCHAR) AS best_category, min(coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(quantile_cont({c}, 0.5), 0) FROM bv))) = "
        f"max(coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(quantile_cont({c}, 0.5), 0) FROM bv))) AS is_const FROM bv"
        for c in _SCREEN_NUM
    )
    cat_long = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, {c} AS level, CAST(is_canceled AS DOUBLE) AS y FROM bv" for c in _SCREEN_CAT)
    return bview(
        f"""
, num AS ({num}),
long AS ({cat_long}),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS nn, sum(CAST(is_canceled AS DOUBLE)) AS t1, sum(CAST(is_canceled AS DOUBLE) * is_canceled) AS t2 FROM bv),
lv AS (SELECT col, level, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s FROM long GROUP BY col, level),
lr AS (SELECT col, level, (nn * s - n * t1) / sqrt(n * (nn - n) * (nn * t2 - t1 * t1)) AS r
       FROM lv CROSS JOIN tot WHERE n < nn),
best AS (SELECT col, level, r, row_number() OVER (PARTITION BY col ORDER BY abs(r) DESC, level IS NULL, level) AS rk FROM lr),
nlev AS (SELECT col, count(level) AS k FROM lv GROUP BY col),
cat AS (SELECT b.col, 'categorical' AS type, b.r, b.col || '_' || coalesce(b.level, 'nan') AS best_category, nlev.k <= 1 AS is_const
        FROM best b JOIN nlev ON b.col = nlev.col WHERE rk = 1),
alls AS (SELECT * FROM num UNION ALL SELECT * FROM cat)
SELECT col AS "column", type,
       round(CASE WHEN is_const THEN NULL ELSE r END, 6) AS correlation,
       round(CASE WHEN is_const THEN NULL ELSE abs(r) END, 6) AS abs_correlation,
       CASE WHEN is_const THEN NULL ELSE best_category END AS best_category,
       CASE WHEN is_const THEN 'constant' WHEN abs(r) >= 0.5 THEN 'leakage' WHEN abs(r) < 0.2 THEN 'not_relevant' ELSE 'useful' END AS reason,
       NOT is_const AND (abs(r) >= 0.5 OR abs(r) < 0.2) AS "drop"
FROM alls
"""
    ).replace(")\n, num AS", "), num AS", 1)


@query("screen_by_target_corr", _screen_oracle())
def q_screen_by_target_corr(spark, sf):
    b = bookings_view(spark, sf).select("is_canceled", *_SCREEN_NUM, *_SCREEN_CAT, "reservation_status_date")
    _, rows = screen.screen_by_target_corr(b, "is_canceled")
    d = screen.decisions_frame(spark, rows)
    return d.select("column", "type", R("correlation").alias("correlation"), R("abs_correlation").alias("abs_correlation"), "best_category", "reason", "drop")


@query(
    "status_leak",
    gview(
        """
, long AS (SELECT 'reservation_status' AS col, reservation_status AS level, CAST(is_canceled AS DOUBLE) AS y FROM g
           UNION ALL SELECT 'arrival_date_month', arrival_date_month, is_canceled FROM g),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS nn, sum(CAST(is_canceled AS DOUBLE)) AS t1 FROM g),
lv AS (SELECT col, level, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s FROM long GROUP BY col, level),
lr AS (SELECT col, level, (nn * s - n * t1) / sqrt(n * (nn - n) * (nn * t1 - t1 * t1)) AS r FROM lv CROSS JOIN tot WHERE n < nn),
best AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY abs(r) DESC, level) AS rk FROM lr)
SELECT col AS "column", 'categorical' AS type, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation,
       col || '_' || level AS best_category,
       CASE WHEN abs(r) >= 0.5 THEN 'leakage' WHEN abs(r) < 0.2 THEN 'not_relevant' ELSE 'useful' END AS reason,
       abs(r) >= 0.5 OR abs(r) < 0.2 AS "drop"
FROM best WHERE rk = 1
"""
    ).replace(")\n\n, long AS", "), long AS", 1),
)
def q_status_leak(spark, sf):
    """C11: a status column that tells the target is found and dropped (beside a column without relevance)."""
    b = guest_bookings(spark, sf).select("is_canceled", "reservation_status", "arrival_date_month")
    kept, rows = screen.screen_by_target_corr(b, "is_canceled")
    d = screen.decisions_frame(spark, [r for r in rows if r["drop"] == (r["column"] not in kept.columns)])
    return d.select("column", "type", R("correlation").alias("correlation"), R("abs_correlation").alias("abs_correlation"), "best_category", "reason", "drop")


_PAIR_COLS = ("l_quantity", "l_extendedprice", "price_copy", "l_discount", "l_tax", "disc_copy")
_PAIR_SQL = """
SELECT l_quantity, l_extendedprice, l_extendedprice * 1.05 + l_tax * 1000 AS price_copy, l_discount, l_tax,
       l_discount * 2 + l_tax * 0.3 AS disc_copy
FROM lineitem"""


def _pairs_frame(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_quantity",
        "l_extendedprice",
        (F.col("l_extendedprice") * 1.05 + F.col("l_tax") * 1000).alias("price_copy"),
        "l_discount",
        "l_tax",
        (F.col("l_discount") * 2 + F.col("l_tax") * 0.3).alias("disc_copy"),
    )


@query(
    "drop_correlated_pairs",
    f"WITH t AS ({_PAIR_SQL}),\np AS (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, abs(corr({a}, {b})) AS r, var_samp({a}) AS v1, var_samp({b}) AS v2 FROM t"
        for i, a in enumerate(_PAIR_COLS)
        for b in _PAIR_COLS[i + 1 :]
    )
    + ")\nSELECT feature_1, feature_2, round(r, 6) AS abs_corr, CASE WHEN v1 < v2 THEN feature_1 ELSE feature_2 END AS dropped FROM p WHERE r > 0.8",
)
def q_drop_correlated_pairs(spark, sf):
    m = screen.moment_matrix(_pairs_frame(spark, sf), list(_PAIR_COLS), fill=0.0)
    pairs, _ = screen.correlated_pairs(m, 0.8)
    return spark.createDataFrame(pairs, "feature_1 string, feature_2 string, abs_corr double, dropped string").select(
        "feature_1", "feature_2", R("abs_corr").alias("abs_corr"), "dropped"
    )


@query("vif")
def q_vif(spark, sf):
    """C13 (rows-only; checked against NumPy OLS in tests): iterative VIF drops on lineitem + near copies."""
    df = _pairs_frame(spark, sf)
    m = screen.moment_matrix(df, list(_PAIR_COLS), fill=0.0)
    scores = screen.vif_scores(m, list(_PAIR_COLS))
    drops = screen.drop_high_vif(m, list(_PAIR_COLS), 10.0, 10)
    dropped = {c: (it, v) for it, c, v in drops}
    rows = [(c, float(scores[c]), dropped.get(c, (None, None))[0]) for c in _PAIR_COLS]
    return spark.createDataFrame(rows, "feature string, vif_first_round double, dropped_at_iteration int")


_VIF_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "quantity_discount")
_VIF_K = len(_VIF_COLS)
_VIF_SQL = "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * l_discount AS quantity_discount FROM lineitem"


# the Gram matrix, scaled to a unit diagonal and inverted by sweeping each column in turn
@query(
    "vif_scores",
    f"""
WITH RECURSIVE t AS ({_VIF_SQL}),
g AS (SELECT [{", ".join(f"sum({a} * {b}) / sqrt(sum({a} * {a}) * sum({b} * {b}))" for a in _VIF_COLS for b in _VIF_COLS)}] AS m FROM t),
s AS (
  SELECT 0 AS k, m FROM g
  UNION ALL
  SELECT k + 1, list_transform(range(0, {_VIF_K * _VIF_K}), lambda c: CASE
    WHEN c // {_VIF_K} = k AND c % {_VIF_K} = k THEN 1 / m[k * {_VIF_K + 1} + 1]
    WHEN c // {_VIF_K} = k THEN m[k * {_VIF_K} + c % {_VIF_K} + 1] / m[k * {_VIF_K + 1} + 1]
    WHEN c % {_VIF_K} = k THEN -m[(c // {_VIF_K}) * {_VIF_K} + k + 1] / m[k * {_VIF_K + 1} + 1]
    ELSE m[c + 1] - m[(c // {_VIF_K}) * {_VIF_K} + k + 1] * m[k * {_VIF_K} + c % {_VIF_K} + 1] / m[k * {_VIF_K + 1} + 1] END)
  FROM s WHERE k < {_VIF_K})
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round(m[{i * (_VIF_K + 1) + 1}], 6) AS vif FROM s WHERE k = {_VIF_K}" for i, c in enumerate(_VIF_COLS))}
""",
)
def q_vif_scores(spark, sf):
    """All factors of lineitem's measures and one product of two."""
    df = table(spark, sf, "lineitem").select(*_VIF_COLS[:-1], (F.col("l_quantity") * F.col("l_discount")).alias(_VIF_COLS[-1]))
    scores = screen.vif_scores(screen.moment_matrix(df, list(_VIF_COLS)), list(_VIF_COLS))
    return spark.createDataFrame(list(scores.items()), "feature string, vif double").select("feature", R("vif").alias("vif"))


# =========================================================== step 6 evaluation
_SCORED_SQL = """
SELECT doc_id, toxic AS label,
       round(0.35 + 0.3 * (1 - quality) + (doc_id % 7) / 20.0, 6) AS score,
       CASE WHEN 0.35 + 0.3 * (1 - quality) + (doc_id % 7) / 20.0 >= 0.5 THEN 1 ELSE 0 END AS prediction,
       round(0.2 + 0.5 * (1 - quality) + (doc_id % 3) / 10.0, 6) AS score_b,
       CASE WHEN 0.2 + 0.5 * (1 - quality) + (doc_id % 3) / 10.0 >= 0.5 THEN 1 ELSE 0 END AS prediction_b
FROM labels"""


def _auc_cte(name: str, score: str) -> str:
    """CTE ``name`` with one column roc_auc from all positive x negative pairs (oracle only)."""
    return (
        f"{name} AS (SELECT round((count(*) FILTER (WHERE p.{score} > q.{score}) + 0.5 * count(*) FILTER (WHERE p.{score} = q.{score}))"
        f" / count(*), 6) AS roc_auc FROM (SELECT * FROM t WHERE label = 1) p CROSS JOIN (SELECT * FROM t WHERE label = 0) q)"
    )


def _scored(spark, sf) -> DataFrame:
    lab = table(spark, sf, "labels")
    s_a = F.lit(0.35) + F.lit(0.3) * (1 - F.col("quality")) + (F.col("doc_id") % 7) / F.lit(20.0)
    s_b = F.lit(0.2) + F.lit(0.5) * (1 - F.col("quality")) + (F.col("doc_id") % 3) / F.lit(10.0)
    return lab.select(
        "doc_id",
        F.col("toxic").alias("label"),
        F.round(s_a, 6).alias("score"),
        F.when(s_a >= 0.5, 1).otherwise(0).alias("prediction"),
        F.round(s_b, 6).alias("score_b"),
        F.when(s_b >= 0.5, 1).otherwise(0).alias("prediction_b"),
    )


@query(
    "confusion",
    f"""
WITH t AS ({_SCORED_SQL}),
c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM t)
SELECT 1 AS actual, 1 AS predicted, tp AS count FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 0, 0, tn FROM c
""",
)
def q_confusion(spark, sf):
    return evaluate.confusion_matrix(_scored(spark, sf), "label", "prediction")


_METRIC_CTE = """
c AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM t)"""


@query(
    "class_report",
    f"""
WITH t AS ({_SCORED_SQL}),{_METRIC_CTE},
m AS (SELECT tp, fp, fn, tn,
             coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
             coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_1, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1_0,
             tp + fn AS s1, tn + fp AS s0 FROM c)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f1_0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1_1, 6), CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', round((tp + tn) / (s0 + s1), 6), round((tp + tn) / (s0 + s1), 6), round((tp + tn) / (s0 + s1), 6), CAST(s0 + s1 AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f1_0 + f1_1) / 2, 6), CAST(s0 + s1 AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 round((f1_0 * s0 + f1_1 * s1) / (s0 + s1), 6), CAST(s0 + s1 AS BIGINT) FROM m
""",
)
def q_class_report(spark, sf):
    r = evaluate.classification_report(_scored(spark, sf), "label", "prediction")
    return r.select("class", *[R(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("roc_auc", f"WITH t AS ({_SCORED_SQL}),\n" + _auc_cte("a", "score") + "\nSELECT roc_auc FROM a")
def q_roc_auc(spark, sf):
    return evaluate.roc_auc_frame(_scored(spark, sf), "label", "score").select(R("roc_auc").alias("roc_auc"))


@query(
    "roc_curve",
    f"""
WITH t AS ({_SCORED_SQL}),
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM t GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM g)
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / (SELECT sum(pos) FROM g), 6) AS tpr, round(fp / (SELECT sum(neg) FROM g), 6) AS fpr FROM c
""",
)
def q_roc_curve(spark, sf):
    r = evaluate.roc_curve(_scored(spark, sf), "label", "score")
    return r.select("threshold", "tp", "fp", R("tpr").alias("tpr"), R("fpr").alias("fpr"))


def _metrics_sql(pred: str, score: str) -> str:
    return f"""
SELECT coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy,
       coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
       coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
FROM (SELECT CAST(count(*) FILTER (WHERE label = 1 AND {pred} = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE label = 0 AND {pred} = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE label = 1 AND {pred} = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (WHERE label = 0 AND {pred} = 0) AS DOUBLE) AS tn FROM t)"""


@query(
    "metrics",
    f"""
WITH t AS ({_SCORED_SQL}),
m AS ({_metrics_sql("prediction", "score")}),
{_auc_cte("a", "score")}
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, roc_auc
FROM m CROSS JOIN a
""",
)
def q_metrics(spark, sf):
    m = evaluate.metrics_frame(_scored(spark, sf), "label", "prediction", "score")
    return m.select(*[R(c).alias(c) for c in evaluate.METRICS])


@query(
    "compare_models",
    f"""
WITH t AS ({_SCORED_SQL}),
ma AS ({_metrics_sql("prediction", "score")}),
mb AS ({_metrics_sql("prediction_b", "score_b")}),
{_auc_cte("aa", "score")},
{_auc_cte("ab", "score_b")},
l AS (
  SELECT 'accuracy' AS metric, round(ma.accuracy, 6) AS a, round(mb.accuracy, 6) AS b FROM ma CROSS JOIN mb
  UNION ALL SELECT 'precision', round(ma.precision, 6), round(mb.precision, 6) FROM ma CROSS JOIN mb
  UNION ALL SELECT 'recall', round(ma.recall, 6), round(mb.recall, 6) FROM ma CROSS JOIN mb
  UNION ALL SELECT 'f1', round(ma.f1, 6), round(mb.f1, 6) FROM ma CROSS JOIN mb
  UNION ALL SELECT 'roc_auc', aa.roc_auc, ab.roc_auc FROM aa CROSS JOIN ab)
SELECT metric, round(a, 6) AS "default", round(b, 6) AS tuned, round(b - a, 6) AS improvement,
       round(CASE WHEN a = 0 THEN NULL ELSE (b - a) * 100.0 / a END, 4) AS improvement_pct
FROM l
""",
)
def q_compare_models(spark, sf):
    s = _scored(spark, sf)
    a = evaluate.metrics_frame(s, "label", "prediction", "score").first().asDict()
    b = evaluate.metrics_frame(s, "label", "prediction_b", "score_b").first().asDict()
    # the comparison works on the reported (rounded) values
    a = {k: round(v, 6) for k, v in a.items()}
    b = {k: round(v, 6) for k, v in b.items()}
    c = evaluate.compare_models(spark, a, b)
    return c.select("metric", R("default").alias("default"), R("tuned").alias("tuned"), R("improvement").alias("improvement"), R("improvement_pct", 4).alias("improvement_pct"))


# ============================================================ step 7 modelling
_SPLIT_ORACLE = bview(
    """
, c AS (SELECT is_canceled AS label, count(*) AS n_y FROM bv GROUP BY is_canceled),
t AS (SELECT sum(n_y) AS n, CAST(ceil(0.2 * sum(n_y)) AS BIGINT) AS n_test FROM c),
a AS (SELECT label, n_y, n_test * n_y // n AS base, (n_test * n_y) % n AS rem, n_test FROM c CROSS JOIN t),
r AS (SELECT *, row_number() OVER (ORDER BY rem DESC, CAST(label AS VARCHAR)) AS rk, n_test - sum(base) OVER () AS left_over FROM a),
s AS (SELECT label, n_y, base + CASE WHEN rk <= left_over THEN 1 ELSE 0 END AS k FROM r)
SELECT label, 'test' AS part, CAST(k AS BIGINT) AS count FROM s
UNION ALL SELECT label, 'train', CAST(n_y - k AS BIGINT) FROM s
"""
).replace(")\n, c AS", "), c AS", 1)


@query("stratified_split_counts", _SPLIT_ORACLE)
def q_stratified_split_counts(spark, sf):
    from ..operators import model

    b = bookings_view(spark, sf)
    train, test = model.stratified_split(b, "is_canceled", 0.2, 42, key_cols=["booking_id"])
    parts = train.select(F.col("is_canceled").alias("label"), F.lit("train").alias("part")).unionByName(
        test.select(F.col("is_canceled").alias("label"), F.lit("test").alias("part"))
    )
    return parts.groupBy("label", "part").agg(F.count(F.lit(1)).alias("count"))


@query(
    "stratified_folds",
    bview(
        """
, c AS (SELECT is_canceled AS label, count(*) AS n_y FROM bv GROUP BY is_canceled),
f AS (SELECT label, CAST(i AS INTEGER) AS fold,
             CASE WHEN i = 4 THEN n_y ELSE greatest((i + 1) * n_y // 5, 1) END - CASE WHEN i = 0 THEN 0 ELSE greatest(i * n_y // 5, 1) END AS cnt
      FROM c CROSS JOIN range(5) AS g(i))
SELECT label, fold, CAST(cnt AS BIGINT) AS count FROM f
"""
    ).replace(")\n, c AS", "), c AS", 1),
)
def q_stratified_folds(spark, sf):
    from ..operators import model

    b = bookings_view(spark, sf)
    f = model.stratified_folds(b, "is_canceled", 5, 42, key_cols=["booking_id"])
    return f.groupBy(F.col("is_canceled").alias("label"), "fold").agg(F.count(F.lit(1)).alias("count"))


@query(
    "class_weights",
    bview(
        """
, c AS (SELECT is_canceled AS label, count(*) AS n_y FROM bv GROUP BY is_canceled)
SELECT label, round((SELECT sum(n_y) FROM c) / ((SELECT count(*) FROM c) * n_y), 6) AS weight FROM c
"""
    ).replace(")\n, c AS", "), c AS", 1),
)
def q_class_weights(spark, sf):
    from ..operators import model

    w = model.class_weights(bookings_view(spark, sf), "is_canceled")
    return spark.createDataFrame([(int(k), float(v)) for k, v in w.items()], "label int, weight double").select("label", R("weight").alias("weight"))


_SMOTE_FEATURES = ("lead_time", "adr", "total_of_special_requests", "previous_cancellations")


@query(
    "smote_balance",
    bview(
        """
, c AS (SELECT is_canceled AS label, count(*) AS n FROM bv GROUP BY is_canceled)
SELECT label, max(n) OVER () AS count FROM c
"""
    ).replace(")\n, c AS", "), c AS", 1),
)
def q_smote_balance(spark, sf):
    from ..operators import model

    b = bookings_view(spark, sf).select("is_canceled", *_SMOTE_FEATURES)
    out = model.smote(b, list(_SMOTE_FEATURES), "is_canceled", k=5, seed=42)
    return out.groupBy(F.col("is_canceled").alias("label")).agg(F.count(F.lit(1)).alias("count"))


_ML_CACHED: list = []


def _release_ml() -> None:
    while _ML_CACHED:
        _ML_CACHED.pop().unpersist()


def _ml_frame(spark, sf) -> DataFrame:
    """Cleaned planted bookings with engineered features (E11 without scaling) for the fits.

    The joined view is persisted for the fit jobs and released by ``_release_ml``.
    """
    from .bookings import planted_bookings
    from .pipeline import engineer_all

    from pyspark import StorageLevel

    b = planted_bookings(spark, sf).drop("booking_id")
    # the view joins four tables; keep it for the fit jobs of the next steps
    b = clean.repair_errors(b).persist(StorageLevel.MEMORY_AND_DISK)
    _ML_CACHED.append(b)
    b = clean.clean_missing(b)
    return engineer_all(b, "is_canceled", scaling=None).frame


@query("fit_random_forest")
def q_fit_random_forest(spark, sf):
    """M2 + M5 + M11 (rows-only): default balanced forest on the planted label."""
    from .training import metrics_row, train_default_forest

    r = train_default_forest(_ml_frame(spark, sf), "is_canceled")
    out = metrics_row(spark, r.name, r.metrics)
    r.release()
    _release_ml()
    return out


@query("fit_logistic")
def q_fit_logistic(spark, sf):
    """M3 + M4 + M9 + M14 (rows-only): progressive selection with SMOTE."""
    from .training import metrics_row, train_logistic

    r = train_logistic(_ml_frame(spark, sf), "is_canceled")
    out = metrics_row(spark, r.name, r.metrics)
    r.release()
    _release_ml()
    return out


@query("fit_boosted_trees")
def q_fit_boosted_trees(spark, sf):
    """M3 + M6 + M9 (rows-only): boosted trees with progressive selection, at the reference's counts and rounds."""
    from .training import metrics_row, train_boosted

    r = train_boosted(_ml_frame(spark, sf), "is_canceled")
    out = metrics_row(spark, r.name, r.metrics)
    r.release()
    _release_ml()
    return out


@query("feature_importance")
def q_feature_importance(spark, sf):
    """M10 (rows-only): impurity importances of the default forest, sorted desc."""
    from ..operators import model
    from .training import train_default_forest

    r = train_default_forest(_ml_frame(spark, sf), "is_canceled")
    r.release()
    _release_ml()
    return model.importance_frame(spark, r.importance)


@query("grid_search")
def q_grid_search(spark, sf):
    """M7 + M8 + M13 (rows-only): CV over the translated reference grid of the forest."""
    from .training import tune_forest

    r = tune_forest(_ml_frame(spark, sf), "is_canceled")
    r.release()
    _release_ml()
    return r.extra["cv_results"]


@query("tune_boosted")
def q_tune_boosted(spark, sf):
    """M7 + M8 (rows-only): CV over the translated reference grid of the boosted trees, on their selected features."""
    from .training import tune_boosted

    r = tune_boosted(_ml_frame(spark, sf), "is_canceled")
    r.release()
    _release_ml()
    return r.extra["cv_results"]


# ============================================================ step 8 reports
@query(
    "dataset_profile",
    f"""
WITH t AS ({_NULLY_ORDERS_SQL})
SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count FROM t
UNION ALL SELECT 'price', count(*) FILTER (WHERE price IS NULL) FROM t
UNION ALL SELECT 'priority', count(*) FILTER (WHERE priority IS NULL) FROM t
UNION ALL SELECT 'status', count(*) FILTER (WHERE status IS NULL) FROM t
UNION ALL SELECT 'odate', count(*) FILTER (WHERE odate IS NULL) FROM t
""",
)
def q_dataset_profile(spark, sf):
    from ..operators import report

    p = report.dataset_profile(_nully_orders(spark, sf))
    return p["nulls"].select("column", "null_count")


@query("dataset_profile_parts")
def q_dataset_profile_parts(spark, sf):
    """P1 (rows-only): all parts of the profile: shape, types, nulls, statistics, first rows."""
    from ..operators import report

    return report.long_form(report.dataset_profile(_nully_orders(spark, sf)))


@query(
    "preview",
    "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50",
)
def q_preview(spark, sf):
    from ..operators import report

    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", R("o_totalprice").alias("o_totalprice")).orderBy("o_orderkey")
    head, _ = report.preview(o, 50)
    return head


@query(
    "top_k",
    "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def q_top_k(spark, sf):
    """The k largest rows (a top-k report: the limit is the feature)."""
    o = table(spark, sf, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10).select("o_orderkey", R("o_totalprice").alias("o_totalprice"))


@query(
    "cleaning_impact",
    f"""
WITH t AS ({_NULLY_ORDERS_SQL}),
n AS (SELECT count(*) AS r,
             count(*) FILTER (WHERE o_orderkey IS NULL) + count(*) FILTER (WHERE price IS NULL) + count(*) FILTER (WHERE priority IS NULL)
             + count(*) FILTER (WHERE status IS NULL) + count(*) FILTER (WHERE odate IS NULL) AS nulls,
             avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END) > 0.3 AS d0, avg(CASE WHEN price IS NULL THEN 1.0 ELSE 0.0 END) > 0.3 AS d1,
             avg(CASE WHEN priority IS NULL THEN 1.0 ELSE 0.0 END) > 0.3 AS d2, avg(CASE WHEN status IS NULL THEN 1.0 ELSE 0.0 END) > 0.3 AS d3,
             avg(CASE WHEN odate IS NULL THEN 1.0 ELSE 0.0 END) > 0.3 AS d4 FROM t)
SELECT 'Rows Removed' AS metric, 0.0 AS value FROM n
UNION ALL SELECT 'Columns Removed', CAST(d0::INT + d1::INT + d2::INT + d3::INT + d4::INT AS DOUBLE) FROM n
UNION ALL SELECT 'Missing Values Fixed', CAST(nulls AS DOUBLE) FROM n
UNION ALL SELECT 'Data Reduction (%)', 0.0 FROM n
""",
)
def q_cleaning_impact(spark, sf):
    """P9 with C1 as the cleaning: sparse columns dropped, the rest imputed (no row removed)."""
    from ..operators import report

    raw = _nully_orders(spark, sf)
    return report.cleaning_impact(raw, clean.clean_missing(raw))


@query(
    "feature_ranking",
    bview(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", round(corr({c}, is_canceled), 6) AS correlation, round(abs(corr({c}, is_canceled)), 6) AS abs_correlation, "
            f"CASE WHEN abs(corr({c}, is_canceled)) > 0.3 THEN 'High' WHEN abs(corr({c}, is_canceled)) > 0.1 THEN 'Medium' ELSE 'Low' END AS tier FROM bv"
            for c in _NUM_BV
        )
    ),
)
def q_feature_ranking(spark, sf):
    from ..operators import report

    b = bookings_view(spark, sf).select("is_canceled", *_NUM_BV)
    r = report.feature_ranking(b, "is_canceled", 20)["ranking"]
    return r.select("column", R("correlation").alias("correlation"), R("abs_correlation").alias("abs_correlation"), "tier")


@query("missing_report")
def q_missing_report(spark, sf):
    """P4 (rows-only): null percentages of all rows and a seeded random sample of the null pattern (1000 rows)."""
    from ..operators import report

    return report.long_form(report.missing_report(_nully_orders(spark, sf)))


_OUTLIER_INT = ("is_canceled", "lead_time", "total_of_special_requests", "is_repeated_guest", "previous_cancellations", "agent")


def _outlier_report_oracle() -> str:
    cells = "\nUNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v, {c != 'adr'} AS whole FROM bv" for c in (*_OUTLIER_INT, "adr"))
    return bview(
        f"""
, cells AS ({cells}),
q AS (SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM cells GROUP BY col),
f AS (SELECT col, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT col, v, lo, hi,
             CASE WHEN v IS NULL OR iqr <= 0 THEN v
                  WHEN whole THEN round_even(least(greatest(v, lo), hi), 0) ELSE least(greatest(v, lo), hi) END AS x
      FROM cells JOIN f USING (col)),
q2 AS (SELECT col, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM w GROUP BY col),
c AS (SELECT col, count(*) FILTER (WHERE v < lo OR v > hi) AS outliers_before,
             count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers_after,
             count(v) AS non_null_before, count(x) AS non_null_after
      FROM w JOIN q2 USING (col) GROUP BY col)
SELECT col AS "column", outliers_before, outliers_after, non_null_before, non_null_after FROM c
WHERE outliers_before <> outliers_after OR non_null_before <> non_null_after
ORDER BY outliers_before - outliers_after DESC, col LIMIT 6
"""
    ).replace(")\n\n, cells AS", "), cells AS", 1)


@query("outlier_report", _outlier_report_oracle())
def q_outlier_report(spark, sf):
    """Outlier counts before/after winsorising the bookings view."""
    from ..operators import report

    b = bookings_view(spark, sf).drop("booking_id")
    return report.outlier_report(b, clean.winsorize_iqr(b))


@query("target_association")
def q_target_association(spark, sf):
    """P7 (rows-only): Pearson r of the numeric and Cramér's V of the text columns of the bookings view, and the target rate."""
    from ..operators import report

    return report.long_form(report.target_association(bookings_view(spark, sf).drop("booking_id"), "is_canceled"))


@query("collinearity_report")
def q_collinearity_report(spark, sf):
    """P8 (rows-only): correlation matrices before and after C14 on lineitem + near copies."""
    from ..operators import report

    before = _pairs_frame(spark, sf)
    after, _ = screen.clean_multicollinearity(before, None)
    return report.long_form(report.collinearity_report(before, after))


@query("pipeline_clean")
def q_pipeline_clean(spark, sf):
    """C15 + P3 (rows-only): the nine cleaning stages on the bookings view; returns the stage shapes."""
    from .pipeline import clean_all

    _, log = clean_all(bookings_view(spark, sf).drop("booking_id"), "is_canceled")
    return log.frame(spark)


@query("pipeline_engineer")
def q_pipeline_engineer(spark, sf):
    """E12 + P6/P10–P13 (rows-only): clean then engineer with scaling; returns the pipeline summary."""
    from ..operators import report
    from .pipeline import fit_transform

    raw = bookings_view(spark, sf).drop("booking_id")
    out, _, _ = fit_transform(raw, "is_canceled")
    return report.pipeline_summary(raw, out, "is_canceled")


@query(
    "isin_frequent",
    """
WITH f AS (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 0.008 * (SELECT count(*) FROM events))
SELECT event_id, CAST(user_id IN (SELECT user_id FROM f) AS INTEGER) AS in_frequent FROM events
""",
)
def q_isin_frequent(spark, sf):
    """Membership of each event's user in the computed frequent-user set (semi-join flag)."""
    e = table(spark, sf, "events")
    n = e.count()
    freq = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= F.lit(0.008 * n)).select("user_id")
    return features.isin_frequent(e.select("event_id", "user_id"), "user_id", freq).select("event_id", "in_frequent")


@query(
    "map_lookup",
    bview(
        """
SELECT booking_id, coalesce(CASE deposit_type WHEN 'No Deposit' THEN 'High' WHEN 'Refundable' THEN 'Medium' WHEN 'Non Refund' THEN 'Low' END, 'Medium') AS deposit_risk
FROM bv
"""
    ),
)
def q_map_lookup(spark, sf):
    """Dictionary lookup with default (null keys take the default)."""
    from ..functions.columns import map_lookup

    b = bookings_view(spark, sf)
    return b.select("booking_id", map_lookup("deposit_type", features.DEPOSIT_RISK, "Medium").alias("deposit_risk"))


@query("compare_importance")
def q_compare_importance(spark, sf):
    """J4 (rows-only): the tuned forest vs the default one on the same split, tuned top 10."""
    from ..operators import model
    from .training import train_default_forest, tune_forest

    b = _ml_frame(spark, sf)
    default = train_default_forest(b, "is_canceled")
    default.release()
    tuned = tune_forest(b, "is_canceled")
    tuned.release()
    _release_ml()
    return model.compare_importance(model.importance_frame(spark, tuned.importance), model.importance_frame(spark, default.importance))


@query("dtype_report")
def q_dtype_report(spark, sf):
    """P6 (rows-only): column counts per type before/after type coercion of the raw order strings."""
    from ..operators import report

    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        "o_orderkey",
        F.lower(F.date_format("o_orderdate", "MMMM")).alias("month_raw"),
        F.when(k % 5 == 0, F.lit("x")).otherwise((k % 3).cast("string")).alias("flag_raw"),
        F.when(k % 7 == 0, F.lit("bad")).otherwise((F.col("o_custkey") * 3 + 0.5).cast("string")).alias("int_raw"),
        (F.col("o_totalprice") / 100).alias("agent_raw"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.lower("o_orderstatus")).alias("status_raw"),
        F.concat(F.lower("o_orderpriority"), F.lit("-ta/to")).alias("kind_raw"),
        F.when(k % 9 == 0, F.lit("not a date")).otherwise(F.to_date("o_orderdate").cast("string")).alias("date_raw"),
    )
    return report.dtype_report(raw, clean.coerce_types(raw, _RAW_SPEC))


@query("feature_step_report")
def q_feature_step_report(spark, sf):
    """P10 (rows-only): histograms, flag totals and target rates of the features built on the bookings view."""
    from ..operators import report

    b = bookings_view(spark, sf)
    t = features.deposit_features(features.market_features(features.level_from_count(features.bucket_flags(b))))
    return report.long_form(report.feature_step_report(b, t, "is_canceled"))


_SCALED_SQL = "SELECT " + ", ".join(
    f"CASE WHEN max({c}) OVER () - min({c}) OVER () > 10 OR max({c}) OVER () > 100 "
    f"THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE {c} END AS {c}"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
) + " FROM lineitem"


@query(
    "scaling_report",
    f"WITH s AS ({_SCALED_SQL})\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", "
        + ", ".join(f"round({f}({c}), 9) + 0.0 AS {n}_before, (SELECT round({f}({c}), 9) + 0.0 FROM s) AS {n}_after" for n, f in (("mean", "avg"), ("std", "stddev_samp")))
        + " FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def q_scaling_report(spark, sf):
    """Mean and std of lineitem columns before/after standard scaling."""
    from ..operators import report

    li = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    r = report.scaling_report(li, features.scale(li, "standard", exclude=()), None)
    return r.select("column", *[(R(c, 9) + F.lit(0.0)).alias(c) for c in r.columns if c != "column"])
