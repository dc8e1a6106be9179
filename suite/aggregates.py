"""Aggregations, set operations and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import shift_hours, start_slot
from tidemark.operators.dedupe import most_frequent
from tidemark.operators.history import change_points
from tidemark.operators.vectors import vector_total
from tidemark.operators.within import CROWD, sums_within
from tidemark.plans.jobs import next_hour

from .base import Data, job_of, query


@query("a_min_max_count", "SELECT user_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS n FROM events GROUP BY 1")
def a_min_max_count(d: Data) -> DataFrame:
    return d.events.groupBy("user_id").agg(
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"), F.count(F.lit(1)).alias("n")
    )


@query("a_distinct", "SELECT DISTINCT user_id, date_trunc('day', ts) AS session FROM events")
def a_distinct(d: Data) -> DataFrame:
    return d.events.select("user_id", F.date_trunc("day", "ts").alias("session")).distinct()


@query(
    "a_count_distinct",
    "SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1",
)
def a_count_distinct(d: Data) -> DataFrame:
    return d.lineitem.groupBy("l_partkey").agg(
        F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_orderkey").alias("orders")
    )


_RADII = (100, 250, 500, 1000)


_RADIUS_COUNTS = f"""WITH u AS (SELECT c_custkey, 25 + (c_custkey * 7919 % 2400) / 100.0 AS lat, -120 + (c_custkey * 104729 % 5000) / 100.0 AS lon, c_nationkey, c_acctbal FROM customer),
       s AS (SELECT s_suppkey, 25 + (s_suppkey * 7919 % 2400) / 100.0 AS lat, -120 + (s_suppkey * 104729 % 5000) / 100.0 AS lon, s_nationkey FROM supplier),
       m AS (SELECT s_suppkey, c_custkey, c_acctbal, 2 * 3959 * asin(sqrt(least(1, pow(sin(radians(u.lat - s.lat) / 2), 2)
              + cos(radians(u.lat)) * cos(radians(s.lat)) * pow(sin(radians(u.lon - s.lon) / 2), 2)))) AS dist
             FROM s JOIN u ON s_nationkey = c_nationkey)
       SELECT s.s_suppkey AS job_id,
         {", ".join(f"count(DISTINCT c_custkey) FILTER (dist <= {r}) AS all_{r}_mile" for r in _RADII)},
         {", ".join(f"count(DISTINCT c_custkey) FILTER (dist <= {r} AND c_acctbal > 0) AS good_{r}_mile" for r in _RADII)}
       FROM s LEFT JOIN m ON m.s_suppkey = s.s_suppkey GROUP BY 1"""


def _radius_counts(d: Data, crowd: int) -> DataFrame:
    """Users are summed per site and the sites around a job counted at once, so nothing is counted by several distincts."""
    users = d.customer.select(
        F.col("c_nationkey").alias("nation"),
        (25 + (F.col("c_custkey") * 7919 % 2400) / 100.0).alias("ulat"),
        (-120 + (F.col("c_custkey") * 104729 % 5000) / 100.0).alias("ulon"),
        (F.col("c_acctbal") > 0).cast("int").alias("good"),
    )
    sites = users.groupBy("nation", "ulat", "ulon").agg(F.count(F.lit(1)).alias("all"), F.sum("good").alias("good"))
    jobs = d.supplier.select(
        F.col("s_suppkey").alias("job_id"),
        F.col("s_nationkey").alias("nation"),
        (25 + (F.col("s_suppkey") * 7919 % 2400) / 100.0).alias("jlat"),
        (-120 + (F.col("s_suppkey") * 104729 % 5000) / 100.0).alias("jlon"),
    )
    counted = sums_within(
        jobs, sites, "job_id", ("jlat", "jlon"), ("ulat", "ulon"), _RADII, ["all", "good"], by=["nation"], crowd=crowd
    )
    names = {f"{kind}_{r}": f"{kind}_{r}_mile" for kind in ("all", "good") for r in _RADII}
    return jobs.select("job_id").join(counted.withColumnsRenamed(names), "job_id", "left").fillna(0)


@query("a_radius_counts", _RADIUS_COUNTS)
def a_radius_counts(d: Data) -> DataFrame:
    return _radius_counts(d, CROWD)


@query("a_radius_counts_crowded", _RADIUS_COUNTS)
def a_radius_counts_crowded(d: Data) -> DataFrame:
    """Points are halved until four are left, so most of the sites are added up for several points at once."""
    return _radius_counts(d, 4)


@query(
    "a_conditional_sum",
    """SELECT user_id, CAST(sum(CASE WHEN event_type = 'click' AND value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS strong_clicks,
       CAST(sum(CASE WHEN event_type = 'purchase' THEN floor(value) ELSE 0 END) AS BIGINT) AS spent FROM events GROUP BY 1""",
)
def a_conditional_sum(d: Data) -> DataFrame:
    kind = F.col("event_type")
    return d.events.groupBy("user_id").agg(
        F.sum(F.when((kind == "click") & (F.col("value") > 20), 1).otherwise(0)).alias("strong_clicks"),
        F.sum(F.when(kind == "purchase", F.floor("value")).otherwise(0)).alias("spent"),
    )


@query(
    "a_mode",
    """SELECT user_id, job_id FROM (SELECT user_id, JOB(event_id) AS job_id, count(*) AS n FROM events GROUP BY 1, 2) c
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, job_id) = 1""",
)
def a_mode(d: Data) -> DataFrame:
    return most_frequent(d.shifts.select("user_id", "job_id"), "user_id", "job_id")


@query(
    "a_sum_avg",
    """SELECT user_id, CAST(sum(hours_worked) AS BIGINT) AS hours, round(avg(job_wage), 6) AS wage FROM {shifts} GROUP BY 1""",
)
def a_sum_avg(d: Data) -> DataFrame:
    return d.shifts.groupBy("user_id").agg(F.sum("hours_worked").alias("hours"), F.avg("job_wage").alias("wage"))


@query(
    "a_pivot",
    """SELECT user_id, date_trunc('day', ts) AS day, max(CAST(floor(value) AS DOUBLE)) FILTER (event_type = 'click') AS click,
       max(CAST(floor(value) AS DOUBLE)) FILTER (event_type = 'view') AS view,
       max(CAST(floor(value) AS DOUBLE)) FILTER (event_type = 'purchase') AS purchase,
       max(CAST(floor(value) AS DOUBLE)) FILTER (event_type = 'signup') AS signup,
       max(CAST(floor(value) AS DOUBLE)) FILTER (event_type = 'error') AS error FROM events GROUP BY 1, 2""",
)
def a_pivot(d: Data) -> DataFrame:
    return (
        d.events.groupBy("user_id", F.date_trunc("day", "ts").alias("day"))
        .pivot("event_type", ["click", "view", "purchase", "signup", "error"])
        .agg(F.max(F.floor("value").cast("double")))
    )


@query(
    "a_hour_bucket",
    """SELECT JOB(event_id) AS job_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS start_date, max(value) AS top, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def a_hour_bucket(d: Data) -> DataFrame:
    return d.events.groupBy(job_of("event_id").alias("job_id"), next_hour("ts").alias("start_date")).agg(
        F.max("value").alias("top"), F.count(F.lit(1)).alias("n")
    )


@query(
    "a_vector_sum",
    """SELECT user_id, array_to_string(list(c ORDER BY h), ',') AS vector FROM (
         SELECT user_id, h, count(*) FILTER ((h - first + 168) % 168 < n) AS c
         FROM (SELECT user_id, dayofweek(shift_start) * 24 + hour(shift_start) AS first,
                 CASE WHEN hour(shift_end) > hour(shift_start) THEN hour(shift_end) - hour(shift_start)
                      ELSE hour(shift_end) - hour(shift_start) + 24 END AS n FROM {shifts}) s, range(168) r(h)
         GROUP BY 1, 2) q GROUP BY 1""",
)
def a_vector_sum(d: Data) -> DataFrame:
    start, end, day = F.hour("shift_start"), F.hour("shift_end"), F.dayofweek("shift_start")
    return vector_total(d.shifts, "user_id", start_slot(start, day), shift_hours(start, end), "vector")


# --- set operations and ordering ---------------------------------------------------------------


@query(
    "u_union_distinct",
    """SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS session FROM events WHERE event_type = 'view'
       UNION SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) FROM events WHERE event_type = 'click'""",
)
def u_union_distinct(d: Data) -> DataFrame:
    def log(kind: str) -> DataFrame:
        return d.events.where(F.col("event_type") == kind).select("user_id", F.to_date("ts").alias("session"))

    return log("view").unionByName(log("click")).distinct()


@query(
    "u_union_all",
    """SELECT job_id, applied_status_start_date AS start_date FROM {applications}
       UNION ALL SELECT job_id, job_created_at FROM {event_jobs}
       UNION ALL SELECT job_id, request_created_at FROM {requests}
       UNION ALL SELECT job_id, request_confirmed_at FROM {requests} WHERE request_confirmed_at IS NOT NULL""",
)
def u_union_all(d: Data) -> DataFrame:
    parts = _instants(d)
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3].dropna())


def _instants(d: Data) -> list[DataFrame]:
    return [
        d.applications.select("job_id", F.col("applied_status_start_date").alias("start_date")),
        d.event_jobs.select("job_id", F.col("job_created_at").alias("start_date")),
        d.requests.select("job_id", F.col("request_created_at").alias("start_date")),
        d.requests.select("job_id", F.col("request_confirmed_at").alias("start_date")),
    ]


@query(
    "u_change_points",
    """SELECT job_id, applied_status_start_date AS start_date FROM {applications}
       UNION SELECT job_id, job_created_at FROM {event_jobs} UNION SELECT job_id, request_created_at FROM {requests}
       UNION SELECT job_id, request_confirmed_at FROM {requests} WHERE request_confirmed_at IS NOT NULL""",
)
def u_change_points(d: Data) -> DataFrame:
    return change_points(_instants(d), "job_id", "start_date")


@query("o_order_by", "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey DESC, o_orderdate, o_orderkey")
def o_order_by(d: Data) -> DataFrame:
    return d.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice").orderBy(
        F.desc("o_custkey"), "o_orderdate", "o_orderkey"
    )


