"""Bookings preset: the only module that knows the bookings column names.

``bookings_view`` projects the supplied TPC-H-style tables into a
bookings-shaped table with planted dirt (negative lead times and agents, null
agents and deposit types, a third ``is_repeated_guest`` value, ``adr`` above
2000), so the cleaning operators have something to fix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import table

TARGET = "is_canceled"

# The projection rules of the bookings-shaped test view.
SEGMENT_OF_MKTSEGMENT = {
    "BUILDING": "Online TA",
    "MACHINERY": "Groups",
    "FURNITURE": "Offline TA/TO",
    "HOUSEHOLD": "Direct",
}
OTHER_SEGMENT = "Aviation"


def bookings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings-shaped projection of orders x customer x nation with per-order line stats.

    Joins: line stats are aggregated by order key first (map-side partial
    aggregation), so the order join reuses that key's partitioning; nation is
    a fixed 25-row dimension that the planner broadcasts by its file size.
    """
    li = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_ret"),
        )
    )
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    seg = F.lit(OTHER_SEGMENT)
    for k, v in reversed(list(SEGMENT_OF_MKTSEGMENT.items())):
        seg = F.when(F.col("c_mktsegment") == k, v).otherwise(seg)
    j = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(li, o.o_orderkey == li.l_orderkey, "left")
    )
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return j.select(
        ok.alias("booking_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_canceled"),
        ((ck * 7 + ok * 13) % 400 - 10 + F.when(ok % 50 == 0, 600).otherwise(0)).alias("lead_time"),
        F.col("n_name").alias("country"),
        seg.alias("market_segment"),
        F.when(F.col("n_ret").isNull(), F.lit(None))
        .when(F.col("n_ret") >= 2, "Non Refund")
        .when(F.col("n_ret") == 1, "Refundable")
        .otherwise("No Deposit")
        .alias("deposit_type"),
        F.coalesce(F.col("n_lines"), F.lit(0)).alias("total_of_special_requests"),
        F.substring("o_orderpriority", 1, 1).alias("assigned_room_type"),
        F.when(ck % 40 == 0, 2).when(ck % 9 == 0, 1).otherwise(0).alias("is_repeated_guest"),
        (ck % 6).alias("previous_cancellations"),
        F.when(ok % 11 == 0, F.lit(None)).when(ok % 97 == 0, F.lit(-1)).otherwise(ck % 30).alias("agent"),
        (F.col("o_totalprice") / 200).alias("adr"),
        F.to_date("o_orderdate").alias("reservation_status_date"),
    )


# The same projection as SQL text (runs in Spark SQL and DuckDB); used by the oracles.
BOOKINGS_VIEW_SQL = """
WITH li AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS booking_id,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_canceled,
       (o_custkey * 7 + o_orderkey * 13) % 400 - 10
         + CASE WHEN o_orderkey % 50 = 0 THEN 600 ELSE 0 END AS lead_time,
       n_name AS country,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Online TA' WHEN 'MACHINERY' THEN 'Groups'
            WHEN 'FURNITURE' THEN 'Offline TA/TO' WHEN 'HOUSEHOLD' THEN 'Direct'
            ELSE 'Aviation' END AS market_segment,
       CASE WHEN n_ret IS NULL THEN NULL WHEN n_ret >= 2 THEN 'Non Refund'
            WHEN n_ret = 1 THEN 'Refundable' ELSE 'No Deposit' END AS deposit_type,
       coalesce(n_lines, 0) AS total_of_special_requests,
       substring(o_orderpriority, 1, 1) AS assigned_room_type,
       CASE WHEN o_custkey % 40 = 0 THEN 2 WHEN o_custkey % 9 = 0 THEN 1 ELSE 0 END AS is_repeated_guest,
       o_custkey % 6 AS previous_cancellations,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN -1
            ELSE o_custkey % 30 END AS agent,
       o_totalprice / 200 AS adr,
       CAST(o_orderdate AS DATE) AS reservation_status_date
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN li ON o_orderkey = l_orderkey
"""


def guest_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bookings view with an index column, a duplicate column, guests, arrival parts and a status.

    Some guests are missing or negative, some arrival parts lie outside their ranges.
    """
    k, day = F.col("booking_id"), F.col("reservation_status_date")
    return bookings_view(spark, sf_dir).select(
        "*",
        (k - 1).alias("Unnamed: 0"),
        (k % 6).alias("stays_in_week_nights"),
        (k % 6).alias("stays_in_weeks_nights"),
        F.when(k % 53 == 0, F.lit(None)).when(k % 101 == 0, -1).otherwise(k % 4).alias("adults"),
        (k % 3).alias("children"),
        F.when(k % 89 == 0, -1).when(k % 7 == 0, 1).otherwise(0).alias("babies"),
        (F.year(day) + 24 + F.when(k % 71 == 0, 20).otherwise(0)).cast("long").alias("arrival_date_year"),
        F.date_format(day, "MMMM").alias("arrival_date_month"),
        (k % 60).alias("arrival_date_week_number"),
        (F.dayofmonth(day) + F.when(k % 61 == 0, 31).otherwise(0)).cast("long").alias("arrival_date_day_of_month"),
        F.when(F.col(TARGET) == 1, "Canceled").when(k % 9 == 0, "No-Show").otherwise("Check-Out").alias("reservation_status"),
    )


# The same columns over a relation ``bv`` with the bookings view, as DuckDB SQL.
GUEST_BOOKINGS_SQL = """
SELECT *, booking_id - 1 AS "Unnamed: 0",
       booking_id % 6 AS stays_in_week_nights, booking_id % 6 AS stays_in_weeks_nights,
       CASE WHEN booking_id % 53 = 0 THEN NULL WHEN booking_id % 101 = 0 THEN -1 ELSE booking_id % 4 END AS adults,
       booking_id % 3 AS children,
       CASE WHEN booking_id % 89 = 0 THEN -1 WHEN booking_id % 7 = 0 THEN 1 ELSE 0 END AS babies,
       CAST(year(reservation_status_date) + 24 + CASE WHEN booking_id % 71 = 0 THEN 20 ELSE 0 END AS BIGINT) AS arrival_date_year,
       monthname(reservation_status_date) AS arrival_date_month,
       booking_id % 60 AS arrival_date_week_number,
       CAST(day(reservation_status_date) + CASE WHEN booking_id % 61 = 0 THEN 31 ELSE 0 END AS BIGINT) AS arrival_date_day_of_month,
       CASE WHEN is_canceled = 1 THEN 'Canceled' WHEN booking_id % 9 = 0 THEN 'No-Show' ELSE 'Check-Out' END AS reservation_status
FROM bv
"""


def planted_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bookings view with a learnable target: lead_time > 90, flipped on every tenth booking.

    The engineered features keep that bound as a flag, so a model can reach an
    accuracy of 0.9.

    The supplied order status is close to independent of the other columns, so
    model checks use this planted label (``is_canceled`` is replaced).
    """
    b = bookings_view(spark, sf_dir)
    planted = (F.col("lead_time") > 90).cast("int")
    planted = F.when(F.col("booking_id") % 10 == 0, 1 - planted).otherwise(planted)
    return b.withColumn("is_canceled", planted)
