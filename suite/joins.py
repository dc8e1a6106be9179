"""Joins: equi, outer, interval, look-back, spine and point-in-time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, asof_join_collapsed, key_lookup
from tidemark.operators.hot import SPLIT, Split
from tidemark.operators.intervals import interval_join, lookback_days, valid_at
from tidemark.operators.spine import days_of_periods, entity_days
from tidemark.plans import training
from tidemark.sources.staging import work_dir
from tidemark.sources.tables import FeatureTable, publish_bucketed

from .base import Data, query

# low enough that some users of the small tables are hot, so both ways run
TIGHT = Split(hot_rows=70, unit="day")


@query(
    "j_left",
    """SELECT o_orderkey, c_custkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def j_left(d: Data) -> DataFrame:
    placed = d.orders.join(d.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return placed.join(d.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "o_orderkey", "c_custkey", "c_name", "n_name"
    )


@query("j_inner", "SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j_inner(d: Data) -> DataFrame:
    return d.lineitem.join(d.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "o_custkey", "o_orderdate"
    )


@query(
    "j_full_outer",
    """SELECT coalesce(a.job_id, v.job_id) AS job_id, coalesce(a.at, v.at) AS start_date, coalesce(apps, 0) AS apps, coalesce(views, 0) AS views
       FROM (SELECT job_id, created_at AS at, count(*) AS apps FROM {job_applies} GROUP BY 1, 2) a
       FULL JOIN (SELECT job_id, received_at AS at, count(*) AS views FROM {job_views} GROUP BY 1, 2) v
         ON a.job_id = v.job_id AND a.at = v.at""",
)
def j_full_outer(d: Data) -> DataFrame:
    apps = d.job_applies.groupBy("job_id", F.col("created_at").alias("start_date")).agg(F.count(F.lit(1)).alias("apps"))
    views = d.job_views.groupBy("job_id", F.col("received_at").alias("start_date")).agg(F.count(F.lit(1)).alias("views"))
    return apps.join(views, ["job_id", "start_date"], "full").fillna(0, ["apps", "views"])


@query(
    "j_full_residual",
    """SELECT coalesce(n.user_id, s.user_id) AS user_id, min(n.a) AS ncns_min, max(n.b) AS ncns_max, min(s.a) AS snc_min, max(s.b) AS snc_max
       FROM (SELECT user_id, min(no_show_shift_start_time_utc) AS a, max(no_show_shift_start_time_utc) AS b FROM {no_shows} GROUP BY 1) n
       FULL JOIN (SELECT user_id, min(cancel_timestamp_utc) AS a, max(cancel_timestamp_utc) AS b FROM {cancellations} GROUP BY 1) s
         ON n.user_id = s.user_id AND (n.a >= TIMESTAMP '2024-01-02' OR n.a IS NULL) AND (s.a >= TIMESTAMP '2024-01-02' OR s.a IS NULL)
       GROUP BY 1""",
)
def j_full_residual(d: Data) -> DataFrame:
    """The predicate stays in the condition, so it unpairs rows and drops none."""
    start = F.lit("2024-01-02").cast("timestamp_ntz")
    missed = d.no_shows.groupBy("user_id").agg(
        F.min("no_show_shift_start_time_utc").alias("na"), F.max("no_show_shift_start_time_utc").alias("nb")
    )
    cancelled = d.cancellations.groupBy(F.col("user_id").alias("snc_user")).agg(
        F.min("cancel_timestamp_utc").alias("sa"), F.max("cancel_timestamp_utc").alias("sb")
    )
    paired = (
        (F.col("user_id") == F.col("snc_user"))
        & ((F.col("na") >= start) | F.col("na").isNull())
        & ((F.col("sa") >= start) | F.col("sa").isNull())
    )
    return missed.join(cancelled, paired, "full").groupBy(F.coalesce("user_id", "snc_user").alias("user_id")).agg(
        F.min("na").alias("ncns_min"), F.max("nb").alias("ncns_max"), F.min("sa").alias("snc_min"), F.max("sb").alias("snc_max")
    )


@query(
    "j_left_residual",
    """SELECT c_custkey, CAST(o_orderkey AS DOUBLE) AS o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'O' AND c_acctbal > 0""",
)
def j_left_residual(d: Data) -> DataFrame:
    matched = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_orderstatus") == "O") & (F.col("c_acctbal") > 0)
    return d.customer.join(d.orders, matched, "left").select("c_custkey", F.col("o_orderkey").cast("double"))


@query(
    "j_interval_closed",
    """SELECT e.event_id, s.status, s.start_date, s.end_date
       FROM events e JOIN {status} s ON s.user_id = e.user_id AND e.ts BETWEEN s.start_date AND s.end_date""",
)
def j_interval_closed(d: Data) -> DataFrame:
    points = d.events.select("user_id", "event_id", "ts")
    return interval_join(
        points, d.status.drop("event_id"), "user_id", "ts", "start_date", "end_date", bounds="[]"
    ).drop("user_id", "ts")


_HALF_OPEN = """SELECT e.event_id, before.status AS status_before, now.status AS status_now
       FROM events e LEFT JOIN {status} before ON before.user_id = e.user_id AND before.start_date < e.ts AND e.ts <= before.end_date
       LEFT JOIN {status} now ON now.user_id = e.user_id AND now.start_date <= e.ts AND e.ts < now.end_date"""


def _half_open(d: Data, split: Split) -> DataFrame:
    points = d.events.select("user_id", "event_id", "ts")
    before = valid_at(points, d.status, "user_id", "ts", "start_date", "end_date", ["status"], bounds="(]", split=split)
    both = valid_at(
        before.withColumnRenamed("status", "status_before"), d.status, "user_id", "ts", "start_date", "end_date",
        ["status"], bounds="[)", split=split, point_rows=d.events,
    )
    return both.select("event_id", "status_before", F.col("status").alias("status_now"))


@query("j_interval_half_open", _HALF_OPEN)
def j_interval_half_open(d: Data) -> DataFrame:
    return _half_open(d, SPLIT)


@query("j_interval_half_open_hot", _HALF_OPEN)
def j_interval_half_open_hot(d: Data) -> DataFrame:
    return _half_open(d, TIGHT)


@query(
    "j_interval_ties",
    """WITH changes AS (SELECT user_id, date_trunc('day', ts) AS day, event_id FROM events),
       spans AS (SELECT user_id, day AS a, lead(day) OVER (PARTITION BY user_id ORDER BY day, event_id) AS b, event_id AS change FROM changes)
       SELECT e.event_id, CAST(s.change AS DOUBLE) AS change FROM events e LEFT JOIN spans s ON s.user_id = e.user_id AND s.a <= e.ts AND e.ts < s.b""",
)
def j_interval_ties(d: Data) -> DataFrame:
    """Several changes on one day leave empty intervals behind, which must hide nothing."""
    changes = d.events.select("user_id", F.date_trunc("day", "ts").alias("a"), F.col("event_id").alias("change"))
    order = Window.partitionBy("user_id").orderBy("a", "change")
    spans = changes.withColumn("b", F.lead("a").over(order))
    points = d.events.select("user_id", "event_id", "ts")
    met = valid_at(points, spans, "user_id", "ts", "a", "b", ["change"])
    return met.select("event_id", F.col("change").cast("double").alias("change"))  # nullable


@query(
    "j_inequality",
    """SELECT e.event_id, e.user_id, f.first_click FROM events e
       JOIN (SELECT user_id, min(ts) AS first_click FROM events WHERE event_type = 'click' GROUP BY 1) f
         ON f.user_id = e.user_id AND e.ts >= f.first_click""",
)
def j_inequality(d: Data) -> DataFrame:
    """One side has one row per key, so the inequality cannot fan out."""
    first = d.events.where(F.col("event_type") == "click").groupBy("user_id").agg(F.min("ts").alias("first_click"))
    return d.events.join(first, "user_id").where(F.col("ts") >= F.col("first_click")).select(
        "event_id", "user_id", "first_click"
    )


@query(
    "j_lookback",
    """SELECT c.cancel_id, s.session AS event_day FROM {cancel_labels} c
       JOIN (SELECT DISTINCT user_id, date_trunc('day', ts) AS session FROM events WHERE event_type = 'click') s
         ON s.user_id = c.cancel_user_id AND c.cancel_created_at >= s.session
        AND date_sub('day', c.cancel_created_at, s.session) > -7""",
)
def j_lookback(d: Data) -> DataFrame:
    sessions = d.events.where(F.col("event_type") == "click").select("user_id", F.to_date("ts").alias("day")).distinct()
    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_created_at")
    return lookback_days(labels, sessions, {"cancel_user_id": "user_id"}, "cancel_created_at", "day").select(
        "cancel_id", "event_day"
    )


@query(
    "j_range_to_equi",
    """SELECT p.period, count(*) AS n, CAST(sum(hours) AS BIGINT) AS hours
       FROM (SELECT CAST(shift_start AS DATE) AS day, sum(hours_worked) AS hours FROM {shifts} GROUP BY 1) s
       JOIN {fiscal_periods} p ON s.day BETWEEN p.start_date AND p.end_date GROUP BY 1""",
)
def j_range_to_equi(d: Data) -> DataFrame:
    daily = d.shifts.groupBy(F.to_date("shift_start").alias("calendar_date")).agg(F.sum("hours_worked").alias("hours"))
    days = days_of_periods(d.fiscal_periods, "start_date", "end_date")
    return daily.join(days, "calendar_date").groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("hours").alias("hours")
    )


@query(
    "j_spine",
    """SELECT user_id, CAST(d AS TIMESTAMP) AS calendar_date FROM (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1) u
       JOIN (SELECT CAST(range AS DATE) AS d FROM range(DATE '2023-12-01', DATE '2024-12-31', INTERVAL 1 DAY)) c
         ON d > a AND d <= CAST(b AS DATE) + 90 AND d <= DATE '2024-03-01'""",
)
def j_spine(d: Data) -> DataFrame:
    users = d.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    last = F.least(F.date_add(F.to_date("b"), 90), F.to_date(F.lit("2024-03-01")))
    return entity_days(users, "user_id", F.date_add(F.to_date("a"), 1), last)


@query(
    "j_spine_or",
    """SELECT user_id, CAST(d AS TIMESTAMP) AS calendar_date
       FROM (SELECT user_id, min(CAST(ts AS DATE)) FILTER (event_type = 'signup' AND value > 150) AS na, max(CAST(ts AS DATE)) FILTER (event_type = 'signup' AND value > 150) AS nb,
               min(CAST(ts AS DATE)) FILTER (event_type = 'error' AND value > 100) AS sa, max(CAST(ts AS DATE)) FILTER (event_type = 'error' AND value > 100) AS sb
             FROM events GROUP BY 1) u
       JOIN (SELECT CAST(range AS DATE) AS d FROM range(DATE '2023-12-01', DATE '2024-12-31', INTERVAL 1 DAY)) c
         ON (d >= na OR d >= sa) AND (d <= nb OR d <= sb)""",
)
def j_spine_or(d: Data) -> DataFrame:
    """Either of two nullable ranges may begin or end the span: least and greatest skip NULLs."""
    day = F.to_date("ts")
    missed = (F.col("event_type") == "signup") & (F.col("value") > 150)
    cancelled = (F.col("event_type") == "error") & (F.col("value") > 100)
    spans = d.events.groupBy("user_id").agg(
        F.min(F.when(missed, day)).alias("na"), F.max(F.when(missed, day)).alias("nb"),
        F.min(F.when(cancelled, day)).alias("sa"), F.max(F.when(cancelled, day)).alias("sb"),
    )
    return entity_days(spans, "user_id", F.least("na", "sa"), F.greatest("nb", "sb"))


@query(
    "j_detail_fetch",
    """SELECT c.o_custkey, o.o_orderkey, o.o_orderdate, o.o_totalprice, o.o_orderpriority
       FROM (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) c
       JOIN orders o ON o.o_custkey = c.o_custkey AND o.o_totalprice = c.top
       QUALIFY row_number() OVER (PARTITION BY c.o_custkey ORDER BY o.o_orderkey DESC) = 1""",
)
def j_detail_fetch(d: Data) -> DataFrame:
    """The chosen row travels through the aggregate, so it need not be fetched again."""
    row = F.struct("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    best = d.orders.groupBy("o_custkey").agg(F.max_by(row, F.struct("o_totalprice", "o_orderkey")).alias("r"))
    return best.select("o_custkey", "r.*")


_ASOF = """SELECT c.cancel_id, c.cancel_user_id, c.cancel_created_at, CAST(p.event_id AS DOUBLE) AS purchase_id, p.value AS purchase_value
       FROM {cancel_labels} c ASOF LEFT JOIN (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase') p
         ON p.user_id = c.cancel_user_id AND p.ts <= c.cancel_created_at"""


def _asof(d: Data, split: Split) -> DataFrame:
    purchases = d.events.where(F.col("event_type") == "purchase")
    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_created_at")
    met = asof_join(
        labels, purchases, {"cancel_user_id": "user_id"}, "cancel_created_at", "ts",
        {"event_id": "purchase_id", "value": "purchase_value"}, split=split,
    )
    return met.withColumn("purchase_id", F.col("purchase_id").cast("double"))  # nullable


@query("j_asof", _ASOF)
def j_asof(d: Data) -> DataFrame:
    return _asof(d, SPLIT)


@query("j_asof_hot", _ASOF)
def j_asof_hot(d: Data) -> DataFrame:
    return _asof(d, Split(hot_rows=27, unit="day"))


@query("j_asof_bucketed", _ASOF)
def j_asof_bucketed(d: Data) -> DataFrame:
    """The purchases are laid out by user once; the lookup reads them without moving them."""
    purchases = d.events.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "value")
    name = f"purchases_{uuid.uuid4().hex}"
    laid = publish_bucketed(FeatureTable("purchases", purchases, ("user_id", "ts"), "ts"), name, f"{work_dir(d.spark)}/{name}", 16)
    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_created_at")
    renames = {"event_id": "purchase_id", "value": "purchase_value"}
    lookup = training.Lookup(laid, "cancel_user_id", "cancel_created_at", tuple(renames), renames)
    return training.build_training_set(labels, [lookup]).withColumn("purchase_id", F.col("purchase_id").cast("double"))


@query(
    "j_asof_one_instant",
    """SELECT l.event_id, p.value AS last_spent FROM (
         SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
                CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-20 12:00:00' ELSE ts END AS at FROM events) l
       ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p ON p.user_id = l.user_id AND p.ts <= l.at""",
)
def j_asof_one_instant(d: Data) -> DataFrame:
    """A third of all labels ask for one user at one instant: it is looked up once."""
    moved = F.col("event_id") % 3 == 0
    at = F.when(moved, F.lit("2024-01-20 12:00:00").cast(dict(d.events.dtypes)["ts"])).otherwise(F.col("ts"))
    labels = d.events.select("event_id", F.when(moved, 1).otherwise(F.col("user_id")).alias("user_id"), at.alias("at"))
    spent = d.events.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("buyer"), F.col("ts").alias("bought_at"), "value")
    found = asof_join_collapsed(labels, spent, {"user_id": "buyer"}, "at", "bought_at", {"value": "last_spent"})
    return found.select("event_id", "last_spent")


@query(
    "j_key_lookup",
    """SELECT s.segment_id, s.user_id, s.job_id, CAST(i.direct_invite AS DOUBLE) AS direct_invite FROM {shifts} s
       LEFT JOIN (SELECT DISTINCT user_id, job_id, 1 AS direct_invite FROM {worked_pairs}) i ON i.user_id = s.user_id AND i.job_id = s.job_id""",
)
def j_key_lookup(d: Data) -> DataFrame:
    invites = d.worked_pairs.groupBy("user_id", "job_id").agg(F.min(F.lit(1.0)).alias("direct_invite"))
    return key_lookup(d.shifts.select("segment_id", "user_id", "job_id"), invites, ["user_id", "job_id"])


@query(
    "j_day_trunc",
    """SELECT u.user_id, CAST(d AS TIMESTAMP) AS calendar_date, count(s.segment_id) AS shifts_yesterday
       FROM (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1) u
       JOIN (SELECT CAST(range AS DATE) AS d FROM range(DATE '2023-12-01', DATE '2024-12-31', INTERVAL 1 DAY)) c
         ON d > a AND d <= CAST(b AS DATE) + 1
       LEFT JOIN {shifts} s ON s.user_id = u.user_id AND CAST(s.shift_start AS DATE) = d - 1 GROUP BY 1, 2""",
)
def j_day_trunc(d: Data) -> DataFrame:
    users = d.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    spine = entity_days(users, "user_id", F.date_add(F.to_date("a"), 1), F.date_add(F.to_date("b"), 1))
    daily = d.shifts.groupBy("user_id", F.date_add(F.to_date("shift_start"), 1).alias("calendar_date")).agg(
        F.count("segment_id").alias("shifts_yesterday")
    )
    return spine.join(daily, ["user_id", "calendar_date"], "left").fillna(0, ["shifts_yesterday"])


@query(
    "j_key_ts",
    """SELECT r.id, r.user_id, r.created_at, f.user_id IS NOT NULL AS is_favorited FROM {ratings} r
       LEFT JOIN {favorites} f ON f.user_id = r.user_id AND f.created_at = r.created_at""",
)
def j_key_ts(d: Data) -> DataFrame:
    marked = d.favorites.withColumn("is_favorited", F.lit(True))
    return d.ratings.join(marked, ["user_id", "created_at"], "left").select(
        "id", "user_id", "created_at", F.coalesce("is_favorited", F.lit(False)).alias("is_favorited")
    )


@query("j_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def j_semi(d: Data) -> DataFrame:
    building = d.customer.where(F.col("c_mktsegment") == "BUILDING")
    return d.orders.join(building, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


@query(
    "j_exists_flag",
    """SELECT segment_id, CASE WHEN (user_id, job_id) IN (SELECT (user_id, job_id) FROM {worked_pairs}) THEN 'Worked' ELSE 'Open' END AS outcome
       FROM {shifts}""",
)
def j_exists_flag(d: Data) -> DataFrame:
    pairs = d.worked_pairs.distinct().withColumn("worked", F.lit(True))
    return d.shifts.join(pairs, ["user_id", "job_id"], "left").select(
        "segment_id", F.when(F.col("worked"), "Worked").otherwise("Open").alias("outcome")
    )
