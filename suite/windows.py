"""Window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import percent_delta, ratio, shift_hours, start_slot
from tidemark.operators.dedupe import keep_first, most_frequent
from tidemark.operators.hot import SPLIT, Split
from tidemark.operators.rolling import rolling_distinct, rolling_means, rolling_totals
from tidemark.operators.running import (
    run_count,
    run_first,
    run_last,
    run_max,
    run_min,
    run_previous,
    run_sum,
    running,
)
from tidemark.operators.spine import entity_days
from tidemark.operators.vectors import running_vector
from tidemark.plans.jobs import attach_group_stats, attach_nested_stats
from tidemark.plans.people import latest_schedule, signed_applicants

from .base import Data, job_of, query
from .joins import TIGHT


@query(
    "w_keep_first",
    """SELECT user_id, segment_id, shift_start, hours_worked FROM {shifts}
       QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', shift_start) ORDER BY hours_worked DESC, shift_start, segment_id) = 1""",
)
def w_keep_first(d: Data) -> DataFrame:
    daily = d.shifts.withColumn("day", F.to_date("shift_start"))
    longest = keep_first(daily, ["user_id", "day"], [F.desc("hours_worked"), F.asc("shift_start"), F.asc("segment_id")])
    return longest.select("user_id", "segment_id", "shift_start", "hours_worked")


@query(
    "w_tie_dedupe",
    "SELECT user_id, created_at, id, rating FROM {ratings} QUALIFY row_number() OVER (PARTITION BY user_id, created_at ORDER BY id) = 1",
)
def w_tie_dedupe(d: Data) -> DataFrame:
    return keep_first(d.ratings, ["user_id", "created_at"], [F.asc("id")]).select("user_id", "created_at", "id", "rating")


@query(
    "w_first_value",
    """SELECT DISTINCT o_custkey AS job_id, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS earliest,
       first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS schedule_id FROM orders""",
)
def w_first_value(d: Data) -> DataFrame:
    requests = d.orders.select(
        F.col("o_custkey").alias("work_request_id"), F.col("o_orderkey").alias("schedule_id"), F.col("o_orderdate").alias("created_at")
    )
    earliest = requests.groupBy(F.col("work_request_id").alias("job_id")).agg(
        F.min_by("schedule_id", F.struct("created_at", "schedule_id")).alias("earliest")
    )
    return earliest.join(latest_schedule(requests), "job_id")


_RUNNING_RANGE = """SELECT event_id, count(*) OVER w AS n, CAST(sum(floor(value)) OVER w AS BIGINT) AS total
       FROM (SELECT *, date_trunc('day', ts) AS day FROM events) e WINDOW w AS (PARTITION BY user_id ORDER BY day)"""


def _running_range(d: Data, split: Split) -> DataFrame:
    daily = d.events.withColumn("day", F.date_trunc("day", "ts"))
    return running(
        daily, "user_id", "day", {"n": run_count(F.lit(1)), "total": run_sum(F.floor("value"))}, frame="range", split=split
    ).select("event_id", "n", "total")


@query("w_running_range", _RUNNING_RANGE)
def w_running_range(d: Data) -> DataFrame:
    return _running_range(d, SPLIT)


@query("w_running_range_hot", _RUNNING_RANGE)
def w_running_range_hot(d: Data) -> DataFrame:
    return _running_range(d, TIGHT)


@query("w_running_range_sketch", _RUNNING_RANGE)
def w_running_range_sketch(d: Data) -> DataFrame:
    """Hot keys named by the sketch: one in 40 of all rows makes a key hot."""
    return _running_range(d, Split(hot_rows=max(1, d.events.count() // 40), unit="week"))


@query(
    "w_lag_desc_ties_hot",
    """SELECT event_id, coalesce(lag(value) OVER w, 0) AS before, last_value(value) OVER w AS latest
       FROM (SELECT *, date_trunc('day', ts) AS day FROM events) e WINDOW w AS (PARTITION BY user_id ORDER BY day, event_id DESC)""",
)
def w_lag_desc_ties_hot(d: Data) -> DataFrame:
    daily = d.events.withColumn("day", F.date_trunc("day", "ts"))
    measures = {"before": run_previous("value", F.lit(0.0)), "latest": run_last("value")}
    return running(daily, "user_id", "day", measures, ties=[F.desc("event_id")], split=TIGHT).select("event_id", *measures)


@query(
    "w_lag_null_value",
    """SELECT event_id, lag(large, 1, -1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
       FROM (SELECT *, CASE WHEN value > 50 THEN value END AS large FROM events) e""",
)
def w_lag_null_value(d: Data) -> DataFrame:
    """The default stands where there is no row before; a NULL value before stays NULL."""
    large = d.events.withColumn("large", F.when(F.col("value") > 50, F.col("value")))
    return running(
        large, "user_id", "ts", {"before": run_previous("large", F.lit(-1.0))}, ties=["event_id"], split=TIGHT
    ).select("event_id", "before")


@query(
    "w_running_avg",
    "SELECT id, round(avg(rating) OVER (PARTITION BY user_id ORDER BY created_at), 2) AS avg_rating FROM {ratings}",
)
def w_running_avg(d: Data) -> DataFrame:
    sums = running(
        d.ratings, "user_id", "created_at", {"s": run_sum("rating"), "n": run_count("rating")}, frame="range"
    )
    return sums.select("id", F.round(ratio(F.col("s").cast("double"), "n"), 2).alias("avg_rating"))


@query(
    "w_carry_forward",
    """SELECT event_id, max(value) OVER w AS highest, min(value) OVER w AS lowest FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def w_carry_forward(d: Data) -> DataFrame:
    return running(
        d.events, "user_id", "ts", {"highest": run_max("value"), "lowest": run_min("value")}, ties=["event_id"], split=TIGHT
    ).select("event_id", "highest", "lowest")


def _daily(d: Data) -> DataFrame:
    """One row per user and day of the user's span: shifts, most frequent job, average wage."""
    dated = d.shifts.withColumn("day", F.to_date("shift_start"))
    users = dated.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = entity_days(users, "user_id", F.col("a"), F.col("b"), name="day")
    daily = dated.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("shifts"), F.avg("job_wage").alias("wage"))
    jobs = most_frequent(dated, ["user_id", "day"], "job_id")
    keys = ["user_id", "day"]
    return spine.join(daily, keys, "left").join(jobs, keys, "left").fillna(0, ["shifts"])


_DAILY = """
WITH g AS (SELECT user_id, CAST(shift_start AS DATE) AS d, count(*) AS shifts, avg(job_wage) AS wage FROM {shifts} GROUP BY 1, 2),
u AS (SELECT user_id, min(d) AS a, max(d) AS b FROM g GROUP BY 1),
m AS (SELECT user_id, d, job_id FROM (SELECT user_id, CAST(shift_start AS DATE) AS d, job_id, count(*) AS n FROM {shifts} GROUP BY 1, 2, 3) q
      QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY n DESC, job_id) = 1),
s AS (SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM u),
daily AS (SELECT s.user_id, s.d, coalesce(g.shifts, 0) AS shifts, g.wage, m.job_id
          FROM s LEFT JOIN g ON g.user_id = s.user_id AND g.d = s.d LEFT JOIN m ON m.user_id = s.user_id AND m.d = s.d)
"""

_FRAMES = """
WINDOW wt AS (PARTITION BY user_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       w7 AS (PARTITION BY user_id ORDER BY d ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)
"""


@query(
    "w_rolling_rows",
    f"""{_DAILY}
SELECT user_id, CAST(d AS TIMESTAMP) AS day, CAST(sum(shifts) OVER wt AS BIGINT) AS shifts_total, CAST(sum(shifts) OVER w7 AS BIGINT) AS shifts_7,
       round(avg(wage) OVER wt, 6) AS wage_total, round(avg(wage) OVER w7, 6) AS wage_7 FROM daily {_FRAMES}""",
)
def w_rolling_rows(d: Data) -> DataFrame:
    summed = rolling_totals(_daily(d), "user_id", "day", {"shifts_total": ("shifts", None), "shifts_7": ("shifts", 7)})
    return rolling_means(summed, "user_id", "day", {"wage_total": ("wage", None), "wage_7": ("wage", 7)}).drop(
        "shifts", "wage", "job_id"
    )


@query(
    "w_rolling_distinct",
    f"""{_DAILY}
SELECT user_id, CAST(d AS TIMESTAMP) AS day, count(DISTINCT job_id) OVER wt AS jobs_total, count(DISTINCT job_id) OVER w7 AS jobs_7
FROM daily {_FRAMES}""",
)
def w_rolling_distinct(d: Data) -> DataFrame:
    return rolling_distinct(
        _daily(d), "user_id", "day", {"jobs_total": ("job_id", None), "jobs_7": ("job_id", 7)}
    ).select("user_id", "day", "jobs_total", "jobs_7")


_LONG_FRAMES = "".join(
    f", w{n} AS (PARTITION BY user_id ORDER BY d ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)" for n in (30, 90)
)


@query(
    "w_rolling_distinct_90",
    f"""{_DAILY}
SELECT user_id, CAST(d AS TIMESTAMP) AS day, count(DISTINCT job_id) OVER w30 AS jobs_30, count(DISTINCT job_id) OVER w90 AS jobs_90,
       count(DISTINCT shifts) OVER w30 AS counts_30, round(avg(wage) OVER w90, 6) AS wage_90
FROM daily {_FRAMES} {_LONG_FRAMES}""",
)
def w_rolling_distinct_90(d: Data) -> DataFrame:
    frames = {"jobs_30": ("job_id", 30), "jobs_90": ("job_id", 90), "counts_30": ("shifts", 30)}
    counted = rolling_distinct(_daily(d), "user_id", "day", frames)
    return rolling_means(counted, "user_id", "day", {"wage_90": ("wage", 90)}).drop("shifts", "wage", "job_id")


@query(
    "w_partition_stats",
    """SELECT o_orderkey, round(avg(floor(o_totalprice)) OVER w, 6) AS mean, max(o_totalprice) OVER w AS top,
       CAST(sum(floor(o_totalprice)) OVER w AS BIGINT) AS total FROM orders
       WINDOW w AS (PARTITION BY o_orderpriority, year(o_orderdate), month(o_orderdate))""",
)
def w_partition_stats(d: Data) -> DataFrame:
    whole = F.floor("o_totalprice")
    by = {"p": F.col("o_orderpriority"), "y": F.year("o_orderdate"), "m": F.month("o_orderdate")}
    stats = {"mean": F.avg(whole), "top": F.max("o_totalprice"), "total": F.sum(whole)}
    return attach_group_stats(d.orders, by, stats).select("o_orderkey", *stats)


@query(
    "w_partition_stats_multi",
    """SELECT l_orderkey, l_linenumber, round(avg(floor(l_extendedprice)) OVER i, 6) AS mean, count(DISTINCT l_orderkey) OVER i AS orders,
       count(DISTINCT l_orderkey) OVER o AS all_orders, CAST(sum(floor(l_extendedprice)) OVER o AS BIGINT) AS total,
       round(avg(l_quantity) OVER o, 6) AS quantity FROM lineitem
       WINDOW i AS (PARTITION BY l_suppkey, year(l_shipdate), l_returnflag, l_linestatus), o AS (PARTITION BY l_suppkey, year(l_shipdate))""",
)
def w_partition_stats_multi(d: Data) -> DataFrame:
    """Two nested groups at once; an order with several flags counts once in the outer one."""
    lines = d.lineitem.withColumn("whole", F.floor("l_extendedprice"))
    outer = {"supplier": F.col("l_suppkey"), "year": F.year("l_shipdate")}
    inner = {"flag": F.col("l_returnflag"), "status": F.col("l_linestatus")}
    stats = {
        "mean": ("inner", "mean", "whole"), "orders": ("inner", "units", None), "all_orders": ("outer", "units", None),
        "total": ("outer", "sum", "whole"), "quantity": ("outer", "mean", "l_quantity"),
    }
    found = attach_nested_stats(lines, outer, inner, "l_orderkey", stats)
    return found.select("l_orderkey", "l_linenumber", *stats)


@query(
    "w_dense_rank_distinct",
    """SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) OVER (PARTITION BY l_partkey) AS suppliers FROM lineitem""",
)
def w_dense_rank_distinct(d: Data) -> DataFrame:
    by = {"part": F.col("l_partkey")}
    return attach_group_stats(d.lineitem, by, {"suppliers": F.countDistinct("l_suppkey")}).select(
        "l_orderkey", "l_linenumber", "suppliers"
    )


@query(
    "w_delta_vs_mean",
    """SELECT job_id, round(job_wage - a, 6) AS wage_delta, round(CASE WHEN a > 0 THEN (job_wage / a - 1) * 100 ELSE 0 END, 6) AS wage_delta_percent
       FROM (SELECT *, avg(job_wage) OVER (PARTITION BY job_zipcode, job_type, job_title, year(job_created_at)) AS a FROM {market_jobs}) j""",
)
def w_delta_vs_mean(d: Data) -> DataFrame:
    by = {"z": F.col("job_zipcode"), "t": F.col("job_type"), "n": F.col("job_title"), "y": F.year("job_created_at")}
    compared = attach_group_stats(d.market_jobs, by, {"mean": F.avg("job_wage")})
    return compared.select(
        "job_id", (F.col("job_wage") - F.col("mean")).alias("wage_delta"),
        percent_delta("job_wage", "mean").alias("wage_delta_percent"),
    )


@query(
    "w_lag_effective",
    """SELECT event_id, lag(ts, 1, TIMESTAMP '2001-01-01') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS start_date FROM events""",
)
def w_lag_effective(d: Data) -> DataFrame:
    opening = F.lit("2001-01-01").cast("timestamp_ntz")
    return running(
        d.events, "user_id", "ts", {"start_date": run_previous("ts", opening)}, ties=["event_id"], split=TIGHT
    ).select("event_id", "start_date")


@query(
    "w_running_vector",
    """SELECT user_id, shift_start, array_to_string(list(c ORDER BY h), ',') AS vector FROM (
         SELECT user_id, shift_start, h, count(*) FILTER ((h - first + 168) % 168 < n) OVER (PARTITION BY user_id, h ORDER BY shift_start) AS c
         FROM (SELECT user_id, shift_start, dayofweek(shift_start) * 24 + hour(shift_start) AS first,
                 CASE WHEN hour(shift_end) > hour(shift_start) THEN hour(shift_end) - hour(shift_start)
                      ELSE hour(shift_end) - hour(shift_start) + 24 END AS n FROM {shifts}) s, range(168) r(h)) q GROUP BY 1, 2""",
)
def w_running_vector(d: Data) -> DataFrame:
    start, end, day = F.hour("shift_start"), F.hour("shift_end"), F.dayofweek("shift_start")
    return running_vector(
        d.shifts, "user_id", "shift_start", start_slot(start, day), shift_hours(start, end), "vector", split=TIGHT
    )


@query(
    "w_forward_fill",
    """SELECT event_id, first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS first_purchase,
       last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS latest_purchase FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def w_forward_fill(d: Data) -> DataFrame:
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return running(
        d.events, "user_id", "ts", {"first_purchase": run_first(bought), "latest_purchase": run_last(bought)},
        ties=["event_id"], split=TIGHT,
    ).select("event_id", "first_purchase", "latest_purchase")


@query(
    "w_running_ratio",
    """SELECT event_id, round(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w / nullif(count(*) OVER w, 0), 6) AS bought_share,
       round(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w
             / nullif(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w, 0), 6) AS bought_per_click
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def w_running_ratio(d: Data) -> DataFrame:
    kind = F.col("event_type")
    sums = running(
        d.events, "user_id", "ts",
        {"n": run_count(F.lit(1)), "bought": run_sum((kind == "purchase").cast("int")), "clicked": run_sum((kind == "click").cast("int"))},
        ties=["event_id"],
    )
    return sums.select("event_id", ratio("bought", "n").alias("bought_share"), ratio("bought", "clicked").alias("bought_per_click"))


@query(
    "w_signed_running_sum",
    """SELECT DISTINCT job_id, start_date, CAST(sum(CASE WHEN status IN ('click', 'purchase') THEN 1 ELSE -1 END)
         OVER (PARTITION BY job_id ORDER BY start_date) AS BIGINT) AS total_applicants
       FROM (SELECT JOB(event_id) AS job_id, event_type AS status, ts AS start_date FROM events WHERE event_type <> 'view') c""",
)
def w_signed_running_sum(d: Data) -> DataFrame:
    changes = d.status.select(job_of("event_id").alias("job_id"), "status", "start_date")
    return signed_applicants(changes, plus=["click", "purchase"], minus=["signup", "error"], split=TIGHT)
