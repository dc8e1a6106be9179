"""Pipelines over shifts: hour-of-week vectors and the hours-worked calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import complete_units, shift_hours, start_slot
from ..operators.dedupe import keep_first, most_frequent
from ..operators.hot import SPLIT, Split
from ..operators.rolling import rolling_distinct, rolling_means, rolling_totals
from ..operators.spine import days_of_periods, entity_days
from ..operators.vectors import running_vector, vector_total


def _clock(start: str, end: str) -> tuple[Column, Column, Column]:
    return F.hour(start), F.hour(end), F.dayofweek(start)


def job_schedule(segments: DataFrame, jobs: DataFrame, created_from: str | None = None) -> DataFrame:
    """One 168-vector per job: how many of its shifts cover each hour of the week.

    ``segments``: job_id, start_time, end_time. ``jobs``: job_id, job_created_at (unique per job).
    """
    if created_from is not None:
        jobs = jobs.where(F.col("job_created_at") >= F.lit(created_from).cast(dict(jobs.dtypes)["job_created_at"]))
    start_hour, end_hour, start_day = _clock("start_time", "end_time")
    totals = vector_total(
        segments, "job_id", start_slot(start_hour, start_day), shift_hours(start_hour, end_hour), "job_schedule"
    )
    # vectors are summed per job before the join, which then has one row per job on both sides
    return totals.join(jobs.select("job_id", "job_created_at"), "job_id").select(
        F.col("job_id").cast("string").alias("job_id"), "job_created_at", "job_schedule"
    )


def user_schedule(
    shifts: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    split: Split | None = SPLIT,
) -> DataFrame:
    """Running 168-vector per user and shift start; of shifts starting together the longest counts.

    ``shifts``: user_id, segment_id, shift_start, shift_end.
    """
    kind = dict(shifts.dtypes)["shift_start"]
    if start_date is not None:
        shifts = shifts.where(F.col("shift_start") >= F.lit(start_date).cast(kind))
    if end_date is not None:
        shifts = shifts.where(F.col("shift_start") <= F.lit(end_date).cast(kind))
    measured = shifts.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("shift_start").alias("calendar_date"),
        "shift_end",
        "segment_id",
        complete_units("HOUR", "shift_start", "shift_end").alias("hours"),
    )
    longest = keep_first(
        measured, ["user_id", "calendar_date"], [F.desc("hours"), F.asc("shift_end"), F.asc("segment_id")]
    )
    start_hour, end_hour, start_day = _clock("calendar_date", "shift_end")
    return running_vector(
        longest,
        "user_id",
        "calendar_date",
        start_slot(start_hour, start_day),
        shift_hours(start_hour, end_hour),
        "running_schedule_array",
        split=split,
        sized_by=[measured],
    )


def hours_calendar(
    shifts: DataFrame,
    worked: DataFrame,
    as_of: str,
    *,
    periods: DataFrame | None = None,
    from_date: str | None = None,
    extend_days: int = 90,
    shift_days: int = 1,
) -> DataFrame:
    """Per user and day: rolling shifts, distinct jobs and wage, from the shifts of the day before.

    ``shifts``: user_id, shift_start (who worked when). ``worked``: user_id, job_id, segment_id,
    shift_start, job_wage. The spine runs from the day after the first shift to ``extend_days``
    after the last, ``as_of`` at most. ``periods`` (start_date, end_date) restricts it to days of
    the fiscal calendar. Everything is aggregated per user and day before it meets the spine, so
    the windows see days, not shifts.
    """
    users = shifts.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min("shift_start").alias("first_worked"), F.max("shift_start").alias("last_worked")
    )
    last = F.least(F.date_add(F.to_date("last_worked"), extend_days), F.to_date(F.lit(as_of)))
    spine = entity_days(
        users, "user_id", F.date_add(F.to_date("first_worked"), 1), last, carry=["first_worked"]
    )
    if periods is not None:
        fiscal = days_of_periods(periods, "start_date", "end_date").select("calendar_date").distinct()
        spine = spine.join(fiscal, "calendar_date", "left_semi")

    dated = worked.where(F.col("user_id").isNotNull()).select(
        "user_id",
        F.date_add(F.to_date("shift_start"), shift_days).alias("calendar_date"),
        "job_id",
        "segment_id",
        "job_wage",
    )
    day = ["user_id", "calendar_date"]
    # one pass per (day, job, segment) keeps the distinct count and the mode apart from the average
    daily = dated.groupBy(*day).agg(
        F.countDistinct("segment_id").alias("shifts_worked"), F.avg("job_wage").alias("avg_wage")
    )
    daily = daily.join(most_frequent(dated, day, "job_id", "jobs_worked"), day, "left")
    grid = spine.join(daily, day, "left").withColumn("shifts_worked", F.coalesce("shifts_worked", F.lit(0)))

    rolled = rolling_totals(
        grid,
        "user_id",
        "calendar_date",
        {
            "shifts_worked_total": ("shifts_worked", None),
            "shifts_worked_last_7_days": ("shifts_worked", 7),
            "shifts_worked_last_30_days": ("shifts_worked", 30),
            "shifts_worked_last_90_days": ("shifts_worked", 90),
        },
    )
    rolled = rolling_means(
        rolled,
        "user_id",
        "calendar_date",
        {
            "avg_wage_total": ("avg_wage", None),
            "avg_wage_last_7_days": ("avg_wage", 7),
            "avg_wage_last_30_days": ("avg_wage", 30),
            "avg_wage_last_90_days": ("avg_wage", 90),
        },
    )
    rolled = rolling_distinct(
        rolled,
        "user_id",
        "calendar_date",
        {
            "jobs_worked_total": ("jobs_worked", None),
            "jobs_worked_last_30_days": ("jobs_worked", 30),
            "jobs_worked_last_90_days": ("jobs_worked", 90),
        },
    )
    if from_date is not None:  # after the windows, which need the full history
        rolled = rolled.where(F.col("calendar_date") >= F.to_date(F.lit(from_date)))
    return rolled.withColumn("user_id", F.col("user_id").cast("string")).drop(
        "shifts_worked", "avg_wage", "jobs_worked"
    )
