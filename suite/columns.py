"""Projections, filters, column shaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    complete_units,
    cosine_similarity,
    epoch_to_timestamp,
    haversine_miles,
    local_time,
    minutes_between,
    percent_delta,
    safe_divide,
    week_vector,
)
from tidemark.operators.shape import narrow_types, rename_all, sanitize_names
from tidemark.operators.spine import hours_between
from tidemark.plans.jobs import keyword_bucket

from .base import Data, query

# --- projections and filters ------------------------------------------------------------------


@query("f_project", "SELECT event_id AS id, user_id, ts AS happened_at, event_type AS kind, value * 2 AS doubled FROM events")
def f_project(d: Data) -> DataFrame:
    return d.events.select(
        F.col("event_id").alias("id"), "user_id", F.col("ts").alias("happened_at"),
        F.col("event_type").alias("kind"), (F.col("value") * 2).alias("doubled"),
    )


@query(
    "f_cast",
    """SELECT CAST(event_id AS VARCHAR) AS id, CAST(floor(value) AS INT) AS whole, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day,
       CAST(event_id AS DOUBLE) AS as_double, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k,
       TRY_CAST(event_type AS INT) IS NULL AS dirty FROM events""",
)
def f_cast(d: Data) -> DataFrame:
    return d.events.select(
        F.col("event_id").cast("string").alias("id"),
        F.floor("value").cast("int").alias("whole"),
        F.col("ts").cast("date").alias("day"),
        F.col("event_id").cast("double").alias("as_double"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("event_type").try_cast("int").isNull().alias("dirty"),
    )


@query("f_rename_all", 'SELECT o_orderkey AS "ORDERKEY", o_custkey AS "CUSTKEY", o_orderdate AS "ORDERDATE" FROM orders')
def f_rename_all(d: Data) -> DataFrame:
    return rename_all(d.orders.select("o_orderkey", "o_custkey", "o_orderdate"), lambda c: c[2:].upper())


@query(
    "f_sanitize_names",
    """SELECT user_id, count(*) FILTER (event_type = 'click') AS clicksall, count(*) FILTER (event_type = 'view') AS viewsA1
       FROM events GROUP BY 1""",
)
def f_sanitize_names(d: Data) -> DataFrame:
    counted = d.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks (all)"),
        F.count_if(F.col("event_type") == "view").alias("views, {A}=1"),
    )
    return sanitize_names(counted)


@query(
    "f_narrow_types",
    """SELECT l_orderkey, l_linenumber, round(CAST(CAST(l_partkey AS FLOAT) AS DOUBLE), 6) AS l_partkey,
       round(CAST(CAST(l_suppkey AS FLOAT) AS DOUBLE), 6) AS l_suppkey,
       round(CAST(CAST(CAST(l_quantity AS DECIMAL(12, 2)) AS FLOAT) AS DOUBLE), 6) AS quantity FROM lineitem""",
)
def f_narrow_types(d: Data) -> DataFrame:
    wide = d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("decimal(12,2)").alias("quantity")
    )
    return narrow_types(wide, keep=["l_orderkey"])


@query("f_null_filter", "SELECT * FROM {funnel} WHERE first_shift_worked_date IS NOT NULL AND eligible_date IS NOT NULL")
def f_null_filter(d: Data) -> DataFrame:
    return d.funnel.dropna(subset=["first_shift_worked_date", "eligible_date"])


@query(
    "f_temporal_filter",
    """SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'
       AND value BETWEEN 10 AND 200 AND event_type <> 'error'""",
)
def f_temporal_filter(d: Data) -> DataFrame:
    return d.events.where(
        (F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz"))
        & (F.col("ts") < F.lit("2024-01-22").cast("timestamp_ntz"))
        & F.col("value").between(10, 200)
        & (F.col("event_type") != "error")
    ).select("event_id", "ts", "value")


@query(
    "f_compound_filter",
    """SELECT id, user_id, rating FROM {ratings}
       WHERE CASE WHEN rating = 3 THEN lower(reason) NOT LIKE '%not the right fit%' ELSE TRUE END
         AND (reason IS NULL OR rating < coalesce(length(reason), 2))""",
)
def f_compound_filter(d: Data) -> DataFrame:
    void = F.contains(F.lower("reason"), F.lit("not the right fit")) & (F.col("rating") == 3)
    small = F.col("reason").isNull() | (F.col("rating") < F.coalesce(F.length("reason"), F.lit(2)))
    return d.ratings.where(~void & small).select("id", "user_id", "rating")


@query(
    "f_case_bucket",
    """SELECT job_id, coalesce(list_extract(list_filter(['1st shift', '2nd shift', 'mon-fri'], lambda b: regexp_matches(lower(schedule_name),
         CASE b WHEN '1st shift' THEN '1st|first' WHEN '2nd shift' THEN '2nd|second' ELSE 'mon - fri' END)), 1), 'other') AS bucket,
       CASE WHEN job_wage < 100000 THEN 'low' WHEN job_wage < 300000 THEN 'mid' ELSE 'high' END AS band
       FROM {market_jobs}""",
)
def f_case_bucket(d: Data) -> DataFrame:
    wage = F.col("job_wage")
    names = [("1st shift", ("1st", "first")), ("2nd shift", ("2nd", "second")), ("mon-fri", ("mon - fri",))]
    return d.market_jobs.select(
        "job_id",
        keyword_bucket("schedule_name", names).alias("bucket"),
        F.when(wage < 100000, "low").when(wage < 300000, "mid").otherwise("high").alias("band"),
    )


@query(
    "f_null_default",
    """SELECT job_id, coalesce(invited_worker_count, 0) AS invited, ifnull(schedule_name, 'none') AS schedule,
       CASE WHEN invited_worker_count IS NULL THEN 1 ELSE 0 END AS open_call FROM {market_jobs}""",
)
def f_null_default(d: Data) -> DataFrame:
    filled = d.market_jobs.withColumn("open_call", F.when(F.col("invited_worker_count").isNull(), 1).otherwise(0))
    return filled.fillna({"schedule_name": "none"}).select(
        "job_id",
        F.coalesce("invited_worker_count", F.lit(0)).alias("invited"),
        F.col("schedule_name").alias("schedule"),
        "open_call",
    )


# --- time -------------------------------------------------------------------------------------


@query(
    "x_epoch",
    """SELECT segment_index, make_timestamp(start_time * 1000000) AS start_at,
       make_timestamp(start_time * 1000000) - start_time_offset * INTERVAL '1' MINUTE AS start_local FROM {segments}""",
)
def x_epoch(d: Data) -> DataFrame:
    at = epoch_to_timestamp("start_time")
    return d.segments.select("segment_index", at.alias("start_at"), local_time(at, "start_time_offset").alias("start_local"))


@query(
    "x_date_add",
    """SELECT event_id, ts + INTERVAL 5 HOUR AS plus_hours, ts - INTERVAL 16 HOUR AS notice, ts + INTERVAL 28 DAY AS plus_days,
       CAST(CAST(ts AS DATE) + 90 AS TIMESTAMP) AS plus_90, CAST(CAST(ts AS DATE) - 1 AS TIMESTAMP) AS day_before FROM events""",
)
def x_date_add(d: Data) -> DataFrame:
    return d.events.select(
        "event_id",
        F.timestamp_add("HOUR", F.lit(5), F.col("ts")).alias("plus_hours"),
        F.timestamp_add("HOUR", F.lit(-16), F.col("ts")).alias("notice"),
        F.timestamp_add("DAY", F.lit(28), F.col("ts")).alias("plus_days"),
        F.date_add(F.to_date("ts"), 90).alias("plus_90"),
        F.date_add(F.to_date("ts"), -1).alias("day_before"),
    )


@query(
    "x_date_diff",
    """SELECT job_id, date_sub('day', job_created_at, job_start_date_time) AS whole_days,
       date_sub('hour', job_start_date_time, job_created_at) AS whole_hours_back,
       CAST(CAST(job_start_date_time AS DATE) - CAST(job_created_at AS DATE) AS INT) AS calendar_days FROM {market_jobs}""",
)
def x_date_diff(d: Data) -> DataFrame:
    return d.market_jobs.select(
        "job_id",
        complete_units("DAY", "job_created_at", "job_start_date_time").alias("whole_days"),
        complete_units("HOUR", "job_start_date_time", "job_created_at").alias("whole_hours_back"),
        F.date_diff("job_start_date_time", "job_created_at").alias("calendar_days"),
    )


@query(
    "x_minutes_between",
    """SELECT user_id, user_signup_date,
       round((floor(epoch(eligible_date)) - floor(epoch(user_signup_date))) / 60.0, 6) AS minutes FROM {funnel}""",
)
def x_minutes_between(d: Data) -> DataFrame:
    return d.funnel.select("user_id", "user_signup_date", minutes_between("user_signup_date", "eligible_date").alias("minutes"))


@query(
    "x_date_trunc",
    """SELECT event_id, date_trunc('day', ts) AS day, date_trunc('hour', ts) AS hour, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS as_date
       FROM events""",
)
def x_date_trunc(d: Data) -> DataFrame:
    return d.events.select(
        "event_id", F.date_trunc("day", "ts").alias("day"), F.date_trunc("hour", "ts").alias("hour"), F.to_date("ts").alias("as_date")
    )


@query(
    "x_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q, CAST(month(o_orderdate) AS INT) AS m,
       CAST(weekofyear(o_orderdate) AS INT) AS w, CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow,
       CAST(day(o_orderdate) AS INT) AS dom, CAST(dayofyear(o_orderdate) AS INT) AS doy,
       CAST(isodow(o_orderdate) - 1 AS INT) AS monday_zero, CAST(hour(o_orderdate) AS INT) AS h FROM orders""",
)
def x_date_parts(d: Data) -> DataFrame:
    at = "o_orderdate"
    return d.orders.select(
        "o_orderkey", F.year(at).alias("y"), F.quarter(at).alias("q"), F.month(at).alias("m"), F.weekofyear(at).alias("w"),
        F.dayofweek(at).alias("dow"), F.dayofmonth(at).alias("dom"), F.dayofyear(at).alias("doy"),
        F.weekday(at).alias("monday_zero"), F.hour(at).alias("h"),
    )


@query(
    "x_ts_literals",
    """SELECT event_id, ts >= TIMESTAMP '2024-01-15 00:00:00' AS later_half, coalesce(nullif(ts, ts), TIMESTAMP '2099-01-01') AS open_end,
       ts + INTERVAL '1' HOUR AS next_hour, TIMESTAMP '2024-03-01' - INTERVAL 1 DAY AS cutoff FROM events""",
)
def x_ts_literals(d: Data) -> DataFrame:
    return d.events.select(
        "event_id",
        (F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))).alias("later_half"),
        F.coalesce(F.nullif("ts", "ts"), F.lit("2099-01-01").cast("timestamp_ntz")).alias("open_end"),
        (F.col("ts") + F.expr("interval 1 hour")).alias("next_hour"),
        F.date_sub(F.to_date(F.lit("2024-03-01")), 1).alias("cutoff"),
    )


# --- numbers and places -----------------------------------------------------------------------


@query(
    "x_haversine",
    """SELECT user_id, job_id, round(2 * 3959 * asin(sqrt(h)), 6) AS miles, round(2 * 3956 * asin(sqrt(h)), 6) AS miles_on_demand
       FROM (SELECT c_custkey AS user_id, o_orderkey AS job_id, pow(sin(radians(ulat - jlat) / 2), 2)
               + cos(radians(ulat)) * cos(radians(jlat)) * pow(sin(radians(ulon - jlon) / 2), 2) AS h
             FROM (SELECT c_custkey, o_orderkey, 25 + (c_custkey * 7919 % 2400) / 100.0 AS ulat, -120 + (c_custkey * 104729 % 5000) / 100.0 AS ulon,
                          25 + (o_orderkey * 7919 % 2400) / 100.0 AS jlat, -120 + (o_orderkey * 104729 % 5000) / 100.0 AS jlon
                   FROM orders JOIN customer ON o_custkey = c_custkey) p) q""",
)
def x_haversine(d: Data) -> DataFrame:
    at = ("user_address_latitude", "user_address_longitude", "job_address_latitude", "job_address_longitude")
    met = d.orders.select(F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("user_id")).join(
        d.market_users, "user_id"
    ).join(d.market_jobs.select("job_id", at[2], at[3]), "job_id")
    return met.select(
        "user_id", "job_id", haversine_miles(*at).alias("miles"), haversine_miles(*at, radius=3956.0).alias("miles_on_demand")
    )


@query(
    "x_greatest",
    """SELECT user_id, user_signup_date,
       greatest(user_signup_date, browsed_for_jobs_date, selected_first_job_date, eligible_date, first_shift_worked_date) AS furthest,
       least(user_signup_date, first_shift_worked_date) AS nearest FROM {funnel}""",
)
def x_greatest(d: Data) -> DataFrame:
    stages = ["user_signup_date", "browsed_for_jobs_date", "selected_first_job_date", "eligible_date", "first_shift_worked_date"]
    return d.funnel.select(
        "user_id", "user_signup_date", F.greatest(*stages).alias("furthest"), F.least(stages[0], stages[-1]).alias("nearest")
    )


@query(
    "x_math",
    """SELECT event_id, round(value, 1) AS rounded, round(pow(value, 2), 6) AS squared, round(sqrt(value), 6) AS root,
       round(value * 3 - 1, 6) AS line, CASE WHEN event_id > 0 THEN round((value / event_id - 1) * 100, 6) ELSE 0 END AS percent FROM events""",
)
def x_math(d: Data) -> DataFrame:
    v = F.col("value")
    return d.events.select(
        "event_id", F.round(v, 1).alias("rounded"), F.pow(v, F.lit(2.0)).alias("squared"), F.sqrt(v).alias("root"),
        (v * 3 - 1).alias("line"), percent_delta("value", "event_id").alias("percent"),
    )


@query(
    "x_safe_divide",
    """SELECT l_orderkey, l_linenumber, round(CAST(CAST(CASE WHEN l_discount <> 0 AND l_tax <> 0 THEN l_tax / l_discount END AS FLOAT) AS DOUBLE), 6) AS strict,
       round(CAST(CAST(CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS FLOAT) AS DOUBLE), 6) AS lenient FROM lineitem""",
)
def x_safe_divide(d: Data) -> DataFrame:
    return d.lineitem.select(
        "l_orderkey", "l_linenumber", safe_divide("l_tax", "l_discount").alias("strict"),
        safe_divide("l_tax", "l_discount", null_on_zero_numerator=False).alias("lenient"),
    )


# --- arrays and vectors -----------------------------------------------------------------------


@query(
    "x_arrays",
    """SELECT user_id, len(list_distinct(list(event_type))) AS kinds, count(value) AS n,
       array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kind_list,
       array_to_string(generate_series(1, CAST(count(DISTINCT event_type) AS INT)), ',') AS steps FROM events GROUP BY 1""",
)
def x_arrays(d: Data) -> DataFrame:
    # distinct per user before collecting, so an array holds the kinds and not the events
    kinds = d.events.groupBy("user_id", "event_type").agg(F.count("value").alias("n"))
    lists = kinds.groupBy("user_id").agg(F.collect_list("event_type").alias("types"), F.sum("n").alias("n"))
    return lists.select(
        "user_id",
        F.size(F.array_distinct("types")).cast("bigint").alias("kinds"),
        "n",
        F.array_sort("types").alias("kind_list"),
        F.sequence(F.lit(1), F.size("types")).alias("steps"),
    )


@query(
    "x_hour_of_week",
    """WITH s AS (SELECT segment_id, dayofweek(shift_start) * 24 + hour(shift_start) AS first,
         CASE WHEN hour(shift_end) > hour(shift_start) THEN hour(shift_end) - hour(shift_start)
              ELSE hour(shift_end) - hour(shift_start) + 24 END AS n FROM {shifts})
       SELECT segment_id, array_to_string(list_transform(range(168), lambda h: CAST((h - first + 168) % 168 < n AS INT)), ',') AS vector FROM s""",
)
def x_hour_of_week(d: Data) -> DataFrame:
    return d.shifts.select(
        "segment_id", week_vector(F.hour("shift_start"), F.hour("shift_end"), F.dayofweek("shift_start")).alias("vector")
    )


@query(
    "x_cosine",
    """SELECT a.vec_id, round(CAST(CAST(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS FLOAT) AS DOUBLE), 5) AS cosine
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def x_cosine(d: Data) -> DataFrame:
    following = d.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return d.embeddings.join(following, "vec_id").select(
        "vec_id", F.round(cosine_similarity("embedding", "next").cast("double"), 5).alias("cosine")
    )


@query(
    "s_hour_spine",
    """SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS calendar_hour
       FROM (SELECT date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS b FROM events) e""",
)
def s_hour_spine(d: Data) -> DataFrame:
    bounds = d.events.agg(
        F.date_trunc("hour", F.min("ts")).alias("a"), F.date_trunc("hour", F.max("ts")).alias("b")
    )
    return hours_between(bounds, "a", "b")
