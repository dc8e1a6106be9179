"""Pipelines over people: outcomes, cancellations, ratings, certifications, funnel, invites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_to_timestamp, local_time, minutes_between, ratio
from ..operators.dedupe import keep_first
from ..operators.hot import SPLIT, Split
from ..operators.intervals import valid_at
from ..operators.rolling import rolling_totals
from ..operators.running import run_first, run_last, run_sum, running
from ..operators.shape import sanitize_names
from ..operators.spine import entity_days


def first_shifts(
    segments: DataFrame,
    jobs: DataFrame,
    needed_history: DataFrame,
    as_of: str,
    *,
    since_year: int = 2020,
    ahead_days: int = 28,
    split: Split | None = SPLIT,
) -> DataFrame:
    """First active shift per job, with the head count needed at that time.

    ``segments``: job_id, segment_index, start_time and end_time (epoch seconds), start_time_offset
    (minutes), active, created_at. ``needed_history``: job_id, needed, start_date, end_date.
    ``jobs``: job_id, job_needed_original_count, invited_worker_count.
    """
    start = epoch_to_timestamp("start_time")
    first = (
        segments.where(F.col("active") & (F.col("created_at").cast("timestamp") < start))
        .groupBy("job_id")
        .agg(F.min(F.struct("start_time", "segment_index", "start_time_offset")).alias("__first"))
        .select("job_id", "__first.segment_index", epoch_to_timestamp("__first.start_time").alias("job_start_time"),
                "__first.start_time_offset")
        .withColumn("job_start_time_local", local_time("job_start_time", "start_time_offset"))
        .where(
            (F.year("job_start_time") >= since_year)
            & (F.col("job_start_time") <= F.date_add(F.to_date(F.lit(as_of)), ahead_days).cast("timestamp"))
        )
    )
    needed = valid_at(
        first, needed_history, "job_id", "job_start_time", "start_date", "end_date", ["needed"],
        split=split, point_rows=jobs,
    )
    wanted = F.coalesce("needed", "job_needed_original_count")
    return (
        needed.join(jobs.select("job_id", "job_needed_original_count", "invited_worker_count"), "job_id")
        .withColumn("needed", wanted)
        .where(F.col("invited_worker_count").isNull() | (F.col("invited_worker_count") < F.col("needed")))
    )


def latest_schedule(requests: DataFrame) -> DataFrame:
    """Most recent schedule per work request: schedule_id by created_at, the greater id on a tie."""
    return (
        requests.where(F.col("work_request_id").isNotNull())
        .groupBy(F.col("work_request_id").alias("job_id"))
        .agg(F.max_by("schedule_id", F.struct("created_at", "schedule_id")).alias("schedule_id"))
    )


def work_history(
    segments: DataFrame,
    jobs: DataFrame,
    needed_history: DataFrame,
    applications: DataFrame,
    hours_worked: DataFrame,
    as_of: str,
    *,
    short_notice_hours: int = 16,
    split: Split | None = SPLIT,
) -> DataFrame:
    """Per user and job start: shares of Worked / SNC / Early Cancel / No Cancel outcomes so far.

    ``applications``: user_id, job_id, applied_status_enum, applied_status_start_date, end_date.
    ``hours_worked``: user_id, job_id. An application without an end has no outcome and is not
    counted. Outcomes are summed per user and instant before the running totals, which settles
    ties and leaves the window one row per instant.
    """
    shifts = first_shifts(segments, jobs, needed_history, as_of, split=split)
    applied = (
        applications.where((F.col("applied_status_enum") == 0) & F.col("user_id").isNotNull())
        .groupBy("user_id", "job_id")
        .agg(
            F.min("applied_status_start_date").cast("timestamp").alias("min_successful_app_start"),
            F.max("end_date").cast("timestamp").alias("max_successful_app_end"),
        )
    )
    start, ended = F.col("job_start_time"), F.col("max_successful_app_end")
    notice = F.timestamp_add("HOUR", F.lit(-short_notice_hours), start)
    status = (
        F.when((ended >= notice) & (ended < start), "SNC")
        .when(ended < notice, "Early Cancel")
        .when(ended >= start, "No Cancel")
    )
    worked = hours_worked.select("user_id", "job_id").distinct().withColumn("worked", F.lit(True))
    # the upper bound is on the local start, as published
    until = F.date_sub(F.to_date(F.lit(as_of)), 1).cast("timestamp")
    outcomes = (
        applied.join(shifts.select("job_id", "job_start_time", "job_start_time_local"), "job_id")
        .where((start >= F.col("min_successful_app_start")) & (F.col("job_start_time_local") < until))
        .join(worked, ["user_id", "job_id"], "left")
        .select("user_id", "job_start_time", F.when(F.col("worked"), "Worked").otherwise(status).alias("outcome"))
    )
    labels = {"worked": "Worked", "early_cancel": "Early Cancel", "no_cancel": "No Cancel", "snc": "SNC"}
    instants = outcomes.groupBy("user_id", "job_start_time").agg(
        F.count("outcome").alias("__all"),
        *[F.count_if(F.col("outcome") == text).alias(f"__{name}") for name, text in labels.items()],
    )
    names = ["all", *labels]
    sums = running(
        instants, "user_id", "job_start_time", {f"n_{n}": run_sum(f"__{n}") for n in names},
        split=split, sized_by=[applications],
    )
    kept = F.col("n_worked") + F.col("n_no_cancel")
    return sums.select(
        F.col("user_id").cast("string").alias("user_id"),
        "job_start_time",
        F.col("n_all").alias("total_tracker"),
        *[ratio(f"n_{n}", "n_all").alias(f"{n}_ratio_all") for n in labels],
        ratio("n_worked", kept).alias("worked_ratio_ncns"),
        ratio("n_worked", kept + F.col("n_snc")).alias("worked_ratio_snc"),
    )


def snc_ncns_calendar(
    no_shows: DataFrame, cancellations: DataFrame, from_date: str | None = None
) -> DataFrame:
    """Per user and day: no-shows and short-notice cancellations, daily and rolling.

    ``no_shows``: user_id, segment_id, no_show_shift_start_time_utc. ``cancellations``: user_id,
    snc_index, cancel_timestamp_utc. Each log is counted per day first and stacked, so the two
    are never paired row by row; the span of a user is the least and greatest day of either.
    """
    day = ["user_id", "calendar_date"]
    missed = (
        no_shows.where(F.col("user_id").isNotNull() & F.col("no_show_shift_start_time_utc").isNotNull())
        .groupBy("user_id", F.to_date("no_show_shift_start_time_utc").alias("calendar_date"))
        .agg(F.countDistinct("segment_id").alias("ncns_event"), F.lit(0).cast("bigint").alias("snc_event"))
    )
    cancelled = (
        cancellations.where(F.col("user_id").isNotNull() & F.col("cancel_timestamp_utc").isNotNull())
        .groupBy("user_id", F.to_date("cancel_timestamp_utc").alias("calendar_date"))
        .agg(F.lit(0).cast("bigint").alias("ncns_event"), F.countDistinct("snc_index").alias("snc_event"))
    )
    daily = missed.unionByName(cancelled).groupBy(*day).agg(
        F.sum("ncns_event").alias("ncns_event"), F.sum("snc_event").alias("snc_event")
    )
    spans = daily.groupBy("user_id").agg(F.min("calendar_date").alias("a"), F.max("calendar_date").alias("b"))
    grid = (
        entity_days(spans, "user_id", F.col("a"), F.col("b"))
        .join(daily, day, "left")
        .fillna(0, ["ncns_event", "snc_event"])
    )
    frames = {"total": None, "last_30_days": 30, "last_90_days": 90, "last_365_days": 365}
    rolled = rolling_totals(
        grid,
        "user_id",
        "calendar_date",
        {f"{kind}_shifts_{name}": (f"{kind}_event", n) for kind in ("ncns", "snc") for name, n in frames.items()},
    )
    if from_date is not None:
        rolled = rolled.where(F.col("calendar_date") >= F.to_date(F.lit(from_date)))
    return rolled.withColumn("user_id", F.col("user_id").cast("string"))


# Fixed value: the reason that voids a middling rating
VOID_REASON = "not the right fit"
VOID_RATING = 3


def user_ratings(
    ratings: DataFrame,
    dont_send: DataFrame,
    favorites: DataFrame,
    *,
    split: Split | None = SPLIT,
) -> DataFrame:
    """Per user and instant: average rating, favourites and do-not-send flags so far.

    ``ratings``: id, created_at, user_id, rating, reason. ``dont_send``: rating_id, created_at.
    ``favorites``: user_id, created_at. The void filter keeps three-valued logic: a rating of 3
    without a reason is dropped too. The flag logs multiply ratings they match several times.
    """
    void = F.contains(F.lower("reason"), F.lit(VOID_REASON)) & (F.col("rating") == VOID_RATING)
    # flags are counted per join key first; a rating then weighs as often as it would be matched
    dns = dont_send.groupBy(F.col("rating_id").alias("id")).agg(
        F.count(F.lit(1)).alias("dns_rows"), F.count("created_at").alias("dns_hits")
    )
    fav = favorites.groupBy("user_id", "created_at").agg(F.count(F.lit(1)).alias("fav_rows"))
    rated = (
        ratings.where(~void)
        .join(dns, "id", "left")
        .join(fav, ["user_id", "created_at"], "left")
        .select(
            "user_id",
            F.col("created_at").alias("event_time_stamp"),
            "rating",
            F.coalesce("dns_rows", F.lit(1)).alias("d"),
            F.coalesce("dns_hits", F.lit(0)).alias("h"),
            F.coalesce("fav_rows", F.lit(1)).alias("f"),
            F.coalesce("fav_rows", F.lit(0)).alias("g"),
        )
    )
    copies = F.col("d") * F.col("f")
    instants = rated.groupBy("user_id", "event_time_stamp").agg(
        F.sum(F.col("rating") * copies).alias("__rating"),
        F.sum(F.when(F.col("rating").isNotNull(), copies)).alias("__rated"),
        F.sum(F.col("g") * F.col("d")).alias("__fav"),
        F.sum(F.col("h") * F.col("f")).alias("__dns"),
    )
    sums = running(
        instants, "user_id", "event_time_stamp",
        {n: run_sum(f"__{n}") for n in ("rating", "rated", "fav", "dns")},
        split=split, sized_by=[ratings],
    )
    return sums.select(
        F.col("user_id").cast("string").alias("user_id"),
        "event_time_stamp",
        F.round(ratio(F.col("rating").cast("double"), "rated"), 2).alias("avg_rating"),
        F.col("fav").alias("favorite_tracker"),
        F.col("dns").alias("dns_tracker"),
    )


def user_certifications(
    certifications: DataFrame,
    names: Sequence[str] | None = None,
    *,
    keep: str = "first",
    split: Split | None = SPLIT,
) -> DataFrame:
    """One column per certification, carried forward per user; 0 before the first.

    ``certifications``: user_id, cert_completed_on, cert_name, cert_verified. The columns are the names
    found in the data, in order, or those listed in ``names``, where the schema must not depend on the
    data; a name that is not listed is then refused, never dropped. ``keep`` says whether the first or the last
    value sticks. All columns are carried before any gap is filled.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    measure = run_first if keep == "first" else run_last
    known = F.col("cert_name").isNotNull()
    if names is None:
        # one row per kind of certification, each a column of the result
        names = sorted(r[0] for r in certifications.where(known).select("cert_name").distinct().collect())
    else:
        other = certifications.where(known & ~F.col("cert_name").isin(*names)).select("cert_name").first()
        if other is not None:
            raise ValueError(f"certification not listed: {other[0]!r}")
    wide = (
        certifications.where(F.col("user_id") != 0)
        .groupBy("user_id", "cert_completed_on")
        .pivot("cert_name", list(names))
        .agg(F.max(F.col("cert_verified").cast("int")))
    )
    renamed = wide.select(
        "user_id", "cert_completed_on", *[F.col(f"`{n}`").alias(f"__c{i}") for i, n in enumerate(names)]
    )
    carried = running(
        renamed, "user_id", "cert_completed_on",
        {f"__v{i}": measure(f"__c{i}") for i in range(len(names))},
        split=split, sized_by=[certifications],
    )
    return sanitize_names(
        carried.select(
            F.col("user_id").cast("string").alias("user_id"),
            "cert_completed_on",
            *[F.coalesce(f"__v{i}", F.lit(0)).alias(n) for i, n in enumerate(names)],
        )
    )


def direct_invites(invites: DataFrame) -> DataFrame:
    """Distinct (job, user) pairs with a flag of 1. ``invites``: job_id, user_id."""
    return (
        invites.where(F.col("user_id").isNotNull() & F.col("job_id").isNotNull())
        .groupBy("job_id", "user_id")
        .agg(F.min(F.lit(1)).alias("direct_invite"))
        .select(F.col("user_id").cast("string").alias("user_id"), F.col("job_id").cast("string").alias("job_id"),
                "direct_invite")
    )


def activity_calendar(activity: DataFrame) -> DataFrame:
    """Passthrough of a per-user daily table with its keys in published types."""
    return activity.withColumns(
        {"user_id": F.col("user_id").cast("string"), "calendar_date": F.col("calendar_date").cast("timestamp")}
    )


def funnel_timeline(
    funnel: DataFrame,
    signup: str = "user_signup_date",
    worked: str = "first_shift_worked_date",
    ignore: Sequence[str] = ("i9_section_1_source", "i9_section_2_source", "etl_date"),
) -> DataFrame:
    """Days and minutes from signup to each stage, the furthest date and whether the user ever worked.

    ``funnel`` has user_id and one ``*_date`` column per stage. A user's latest signup counts.
    """
    stages = [c for c in funnel.columns if c.lower().endswith("_date") and c.lower() not in ignore]
    later = [c for c in stages if c != signup]
    furthest = F.greatest(*stages) if len(stages) > 1 else F.col(stages[0])
    known = funnel.where(F.col("user_id").isNotNull()).withColumn("max_date", furthest).where(
        F.col("max_date").isNotNull()
    )
    latest = keep_first(known, "user_id", [F.desc(signup), F.desc("max_date"), *later])
    deltas = []
    for c in later:
        stem = c[: -len("date")]
        deltas.append(F.date_diff(F.col(c), F.col(signup)).alias(f"{stem}days"))
        deltas.append(minutes_between(signup, c).alias(f"{stem}mins"))
    return latest.select(
        F.col("user_id").cast("string").alias("user_id"),
        signup,
        "max_date",
        *deltas,
        F.when(minutes_between(signup, worked).isNotNull(), 1).otherwise(0).alias("ever_worked"),
    )


def signed_applicants(
    status_changes: DataFrame, plus: Sequence[str], minus: Sequence[str],
    *, split: Split | None = SPLIT,
) -> DataFrame:
    """Applicants per job by a signed running sum over status changes: + for one set, - for the other.

    ``status_changes``: job_id, status, start_date. Changes at one instant are summed first.
    """
    step = F.when(F.col("status").isin(list(plus)), 1).when(F.col("status").isin(list(minus)), -1)
    instants = (
        status_changes.withColumn("__step", step)
        .where(F.col("__step").isNotNull())
        .groupBy("job_id", "start_date")
        .agg(F.sum("__step").alias("__step"))
    )
    return running(
        instants, "job_id", "start_date", {"total_applicants": run_sum("__step")}, split=split,
        sized_by=[status_changes],
    ).select("job_id", "start_date", "total_applicants")

