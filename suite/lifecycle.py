"""Sources, staging, publishing, upserts and the training-set operators."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_divide
from tidemark.operators.running import (
    continue_running,
    last_state,
    run_count,
    run_first,
    run_last,
    run_max,
    run_previous,
    run_sum,
    running,
)
from tidemark.operators.vectors import continue_vector
from tidemark.plans import people, shifts, specs, training
from tidemark.sources.staging import stage, work_dir
from tidemark.sources.tables import (
    FeatureTable,
    KeyViolation,
    look_back,
    publish,
    read_query,
    read_sql,
    upsert,
    write_table,
)

from .base import Data, query
from .joins import TIGHT
from .pipelines import _USER_SCHEDULE, AS_OF, WORK_HISTORY


def _folder(d: Data, name: str) -> str:
    return f"{work_dir(d.spark)}/{name}-{uuid.uuid4().hex}"


def _daily_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id", F.to_date("ts").alias("calendar_date")).agg(
        F.count(F.lit(1)).alias("activities"), F.max("value").alias("top_value")
    )


@query(
    "s_source_query",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, date_trunc('day', ts) AS calendar_date, count(*) AS activities, max(value) AS top_value
       FROM events GROUP BY 1, 2""",
)
def s_source_query(d: Data) -> DataFrame:
    events = read_query(d.spark, "parquet", {"path": f"{d.folder}/events.parquet"})
    return people.activity_calendar(_daily_activity(events))


@query("s_stage_roundtrip", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, CAST(job_id AS VARCHAR) AS job_id, 1 AS direct_invite FROM {worked_pairs}")
def s_stage_roundtrip(d: Data) -> DataFrame:
    return stage(people.direct_invites(d.worked_pairs), _folder(d, "direct_invites"))


_DAILY = "SELECT user_id, date_trunc('day', ts) AS calendar_date, count(*) AS activities, max(value) AS top_value FROM events GROUP BY 1, 2"


@query("l_publish_keys", _DAILY)
def l_publish_keys(d: Data) -> DataFrame:
    table = FeatureTable(
        "user_activity", _daily_activity(d.events), ("user_id", "calendar_date"), "calendar_date", "activity per day"
    )
    return publish(table, _folder(d, "user_activity")).df


@query("p_work_history_staged", WORK_HISTORY)
def p_work_history_staged(d: Data) -> DataFrame:
    folder = _folder(d, "work_history")
    history = people.work_history(d.segments, d.event_jobs, d.needed_periods, d.applications, d.worked_pairs, AS_OF)
    table = FeatureTable("work_history", history, ("user_id", "job_start_time"), "job_start_time", "outcomes so far")
    return publish(table, folder, staging=f"{folder}_staging").df


@query("s_full_refresh", _DAILY)
def s_full_refresh(d: Data) -> DataFrame:
    """The second write replaces the first whole, also where the first held more."""
    path = _folder(d, "refreshed")
    stale = _daily_activity(d.events).withColumn("activities", F.lit(-1).cast("bigint"))
    write_table(stale.unionByName(stale.withColumn("user_id", -1 - F.col("user_id"))), path, "overwrite")
    write_table(_daily_activity(d.events), path, "overwrite")
    return d.spark.read.parquet(path)


@query(
    "s_upsert",
    """SELECT user_id, date_trunc('day', ts) AS calendar_date,
         CASE WHEN min(ts) >= TIMESTAMP '2024-01-20' THEN count(*) ELSE -count(*) END AS activities FROM events GROUP BY 1, 2""",
)
def s_upsert(d: Data) -> DataFrame:
    """Days up to the 24th hold negated counts; the update brings the true ones from the 20th on."""
    path = _folder(d, "upserted")
    truth = _daily_activity(d.events).drop("top_value")
    day = F.col("calendar_date")
    old = truth.where(day < F.to_date(F.lit("2024-01-25"))).withColumn("activities", -F.col("activities"))
    write_table(old, path, "error", partition_by=["calendar_date"])
    updates = truth.where(day >= F.to_date(F.lit("2024-01-20")))
    return upsert(d.spark, path, updates, ["user_id", "calendar_date"], partition_by="calendar_date")


@query(
    "s_lookback_upsert",
    """SELECT user_id, date_trunc('day', ts) AS calendar_date, CASE WHEN min(ts) >= TIMESTAMP '2024-01-10' THEN count(*) ELSE 0 END AS activities
       FROM events WHERE ts < TIMESTAMP '2024-01-30' GROUP BY 1, 2""",
)
def s_lookback_upsert(d: Data) -> DataFrame:
    """Reload of the 21 days before the 31st, its eve excluded, into a table whose counts are all 0."""
    path = _folder(d, "incremental")
    blank = _daily_activity(look_back(d.events, "ts", "2024-01-31", 60, 1)).select(
        "user_id", "calendar_date", F.lit(0).cast("bigint").alias("activities")
    )
    write_table(blank, path, partition_by=["calendar_date"])
    recent = _daily_activity(look_back(d.events, "ts", "2024-01-31", 21, 1)).drop("top_value")
    return upsert(d.spark, path, recent, ["user_id", "calendar_date"], partition_by="calendar_date")


def _continued() -> dict:
    return {
        "n": run_count(F.lit(1)),
        "total": run_sum(F.floor("value")),
        "highest": run_max("value"),
        "first_buy": run_first("bought"),
        "last_buy": run_last("bought"),
        "before": run_previous("value", F.lit(-1.0)),
    }


@query(
    "s_continue_running",
    """SELECT user_id, event_id, ts, value, count(*) OVER w AS n, CAST(sum(floor(value)) OVER w AS BIGINT) AS total, max(value) OVER w AS highest,
       first_value(bought IGNORE NULLS) OVER w AS first_buy, last_value(bought IGNORE NULLS) OVER w AS last_buy,
       coalesce(lag(value) OVER w, -1) AS before
       FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS bought FROM events WHERE ts < TIMESTAMP '2024-01-31') e
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def s_continue_running(d: Data) -> DataFrame:
    """Running features of 30 days, published without the rows that came late, then reloaded for the last 10 days:
    only these are read again, seeded with each user's last row before them."""
    path = _folder(d, "running")
    log = look_back(d.events, "ts", "2024-01-31", 400).withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    log = log.select("user_id", "event_id", "ts", "value", "bought")
    recent = look_back(log, "ts", "2024-01-31", 10)
    late = (F.col("ts") >= F.lit("2024-01-21").cast(dict(log.dtypes)["ts"])) & (F.col("event_id") % 3 == 0)
    options, measures = {"ties": ["event_id"], "split": TIGHT}, _continued()
    write_table(running(log.where(~late), "user_id", "ts", measures, **options), path)
    published = d.spark.read.parquet(path)
    start = F.lit("2024-01-21").cast(dict(log.dtypes)["ts"])
    state = last_state(published, "user_id", "ts", [*measures, "value"], start, ties=["event_id"])
    fresh = continue_running(recent, state, "user_id", "ts", measures, seeds={"before": "value"}, **options)
    return upsert(d.spark, path, fresh, ["user_id", "event_id"]).drop("bought")


@query(
    "s_continue_vectors",
    f"""WITH {_USER_SCHEDULE}
SELECT CAST(user_id AS VARCHAR) AS user_id, shift_start AS calendar_date,
       array_to_string(v, ',') AS running_schedule_array FROM user_sched
""",
)
def s_continue_vectors(d: Data) -> DataFrame:
    """Running vectors, published up to a day and continued from each user's last one."""
    path = _folder(d, "vectors")
    write_table(shifts.user_schedule(d.shifts, end_date="2024-01-16 23:59:59"), path)
    published = d.spark.read.parquet(path)
    start = F.lit("2024-01-15").cast(dict(published.dtypes)["calendar_date"])
    state = last_state(published, "user_id", "calendar_date", ["running_schedule_array"], start)
    recent = shifts.user_schedule(d.shifts, start_date="2024-01-15")
    fresh = continue_vector(recent, state, "user_id", "running_schedule_array")
    return upsert(d.spark, path, fresh, ["user_id", "calendar_date"])


_ORDERS = "SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS status FROM orders"


def _orders(d: Data) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus")).alias("status")
    return d.orders.select("o_orderkey", F.floor("o_totalprice").alias("price"), status)


@query("s_upsert_null_partition", _ORDERS)
def s_upsert_null_partition(d: Data) -> DataFrame:
    """The partition of NULL is read and replaced like any other."""
    path, truth = _folder(d, "by_status"), _orders(d)
    late = F.col("o_orderkey") % 3 == 0
    # the key alone: it decides the partition
    write_table(truth.withColumn("price", F.when(late, F.lit(0)).otherwise(F.col("price")).cast("bigint")), path, partition_by=["status"])
    return upsert(d.spark, path, truth.where(late), ["o_orderkey"], partition_by="status")


@query("s_upsert_moved_key", _ORDERS)
def s_upsert_moved_key(d: Data) -> DataFrame:
    """Keys that arrive with another partition value leave their old one."""
    path, truth = _folder(d, "moved"), _orders(d)
    late = F.col("o_orderkey") % 3 == 0
    write_table(truth.withColumn("status", F.when(late, F.lit("new")).otherwise(F.col("status"))), path, partition_by=["status"])
    return upsert(d.spark, path, truth.where(late), ["o_orderkey"], partition_by="status")


@query("s_publish_append", _ORDERS)
def s_publish_append(d: Data) -> DataFrame:
    """Two halves of a table, one after the other; a half that is there already is refused."""
    path, truth = _folder(d, "appended"), _orders(d)
    first, second = (FeatureTable("orders", truth.where(F.col("o_orderkey") % 2 == k), ("o_orderkey",)) for k in (0, 1))
    publish(first, path)
    published = publish(second, path, "append")
    try:
        publish(second, path, "append")
    except KeyViolation:
        return published.df
    raise AssertionError("a repeated key was appended")


@query(
    "l_publish_observed",
    "SELECT count(*) AS n, min(ts) AS first, max(ts) AS last FROM events WHERE event_type = 'purchase'",
)
def l_publish_observed(d: Data) -> DataFrame:
    """Row count and bounds of a published table, gathered while it was written."""
    seen = publish(_purchases(d), _folder(d, "observed")).observed
    if seen["null_keys"]:
        raise AssertionError("NULL keys were published")
    kind = dict(d.events.dtypes)["ts"]
    return d.spark.range(1).select(
        F.lit(seen["rows"]).alias("n"), F.lit(seen["first"]).cast(kind).alias("first"), F.lit(seen["last"]).cast(kind).alias("last")
    )


def _purchases(d: Data) -> FeatureTable:
    bought = d.events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("bought_at"), "event_id", "value", "props"
    )
    return FeatureTable("purchases", bought, ("user_id", "bought_at"), "bought_at", "what a user bought when")


@query(
    "l_lookup_subset",
    """SELECT c.cancel_id, c.cancel_user_id, c.cancel_created_at, c.job_type, p.value AS last_spent FROM {cancel_labels} c
       ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p
         ON p.user_id = c.cancel_user_id AND p.ts <= c.cancel_created_at""",
)
def l_lookup_subset(d: Data) -> DataFrame:
    """Two of the table's five columns are read; the integer lookup key meets a string key."""
    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_created_at", "job_type")
    spent = training.Lookup(_purchases(d), "cancel_user_id", "cancel_created_at", ("value",), {"value": "last_spent"})
    return training.build_training_set(labels, [spent], label="job_type")


@query(
    "l_derived",
    """SELECT c.cancel_id, c.job_type, p.value AS value,
       round(CAST(CAST(CASE WHEN c.cancel_job_id <> 0 AND p.value <> 0 THEN p.value / c.cancel_job_id END AS FLOAT) AS DOUBLE), 6) AS per_job
       FROM {cancel_labels} c ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p
         ON p.user_id = c.cancel_user_id AND p.ts <= c.cancel_created_at""",
)
def l_derived(d: Data) -> DataFrame:
    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_job_id", "cancel_created_at", "job_type")
    return training.build_training_set(
        labels,
        [
            training.Lookup(_purchases(d), "cancel_user_id", "cancel_created_at", ("value",)),
            training.Derived(safe_divide, "per_job", {"numerator": "value", "denominator": "cancel_job_id"}),
        ],
        label="job_type",
        exclude_columns=["cancel_user_id", "cancel_job_id", "cancel_created_at"],
    )


@query(
    "l_named_spec",
    """SELECT c.cancel_id, c.job_type, p.value AS last_spent,
       round(CAST(CAST(CASE WHEN c.cancel_job_id <> 0 AND p.value <> 0 THEN p.value / c.cancel_job_id END AS FLOAT) AS DOUBLE), 6) AS per_job
       FROM {cancel_labels} c ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p
         ON p.user_id = c.cancel_user_id AND p.ts <= c.cancel_created_at""",
)
def l_named_spec(d: Data) -> DataFrame:
    """A spec is stored once, reused when it is equal, refused when it differs, and built from what is stored."""
    bought, folder = _purchases(d), _folder(d, "specs")

    def spec(column: str) -> specs.FeatureSpec:
        spent = training.Lookup(bought, "cancel_user_id", "cancel_created_at", (column,), {column: "last_spent"})
        per_job = training.Derived(safe_divide, "per_job", {"numerator": "last_spent", "denominator": "cancel_job_id"})
        return specs.FeatureSpec(
            "spending", (spent, per_job), "job_type", ("cancel_user_id", "cancel_job_id", "cancel_created_at")
        )

    first = specs.create_spec(d.spark, spec("value"), folder)
    if specs.create_spec(d.spark, spec("value"), folder) != first:
        raise AssertionError("an equal spec was not reused")
    try:
        specs.create_spec(d.spark, spec("event_id"), folder)
    except specs.SpecConflict:
        stored = specs.load_spec(d.spark, "spending", folder, {"purchases": bought}, {"safe_divide": safe_divide})
    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_job_id", "cancel_created_at", "job_type")
    return stored.training_set(labels)


@query(
    "s_sql_parameters",
    """SELECT event_id, user_id, 'it''s; -- a "value"' AS note FROM events
       WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-10' AND value > 12.5""",
)
def s_sql_parameters(d: Data) -> DataFrame:
    """Values reach the query as typed arguments and are never part of its text."""
    return read_sql(
        d.spark,
        "SELECT event_id, user_id, :note AS note FROM {log} WHERE array_contains(:kinds, event_type) AND ts >= :since AND value > :least",
        {"note": 'it\'s; -- a "value"', "kinds": ["click", "view"], "since": dt.datetime(2024, 1, 10), "least": 12.5},
        log=d.events,
    )


_KINDS = ("purchase", "view", "signup")


@query(
    "l_lookup_many",
    f"""SELECT c.cancel_id, c.job_type, {", ".join(f"{k}.value AS last_{k}" for k in _KINDS)} FROM {{cancel_labels}} c
       {" ".join(f"ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = '{k}') {k} ON {k}.user_id = c.cancel_user_id AND {k}.ts <= c.cancel_created_at" for k in _KINDS)}""",
)
def l_lookup_many(d: Data) -> DataFrame:
    """Three tables of one key: the labels are shuffled once."""

    def lookup(kind: str) -> training.Lookup:
        rows = d.events.where(F.col("event_type") == kind).select("user_id", "ts", "value")
        table = FeatureTable(kind, rows, ("user_id", "ts"), "ts")
        return training.Lookup(table, "cancel_user_id", "cancel_created_at", ("value",), {"value": f"last_{kind}"})

    labels = d.cancel_labels.select("cancel_id", "cancel_user_id", "cancel_created_at", "job_type")
    excluded = ["cancel_user_id", "cancel_created_at"]
    return training.build_training_set(labels, list(map(lookup, _KINDS)), "job_type", excluded)
