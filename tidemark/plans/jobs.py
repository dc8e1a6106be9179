"""Pipelines over jobs: change histories, views and applications, applicants, market statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import complete_units, percent_delta, ratio
from ..operators.asof import asof_join
from ..operators.history import change_log_to_history, change_points, in_force_counts
from ..operators.hot import SPLIT, Split, if_hot
from ..operators.running import run_sum, running
from ..operators.within import CROWD, sums_within
from ..sources.staging import stage


def value_change_history(
    current: DataFrame, edits: DataFrame, value: str, *, jobs: DataFrame | None = None,
    prefer: Sequence[str] = (), split: Split | None = SPLIT,
) -> DataFrame:
    """History of a job attribute such as its overfill or needed count: (job, effective start) -> value.

    ``current``: job_id and the attribute. ``edits``: job_id, old_<attribute>, new_<attribute>,
    created_at. ``jobs``: job_id of the jobs to keep.
    """
    history = change_log_to_history(
        current.select("job_id", F.col(value).alias(f"new_{value}")), edits, "job_id",
        f"old_{value}", f"new_{value}", "created_at",
        value=value, prefer=prefer, entities=jobs, split=split,
    )
    return history.withColumn("job_id", F.col("job_id").cast("string"))


def next_hour(ts: str) -> Column:
    """Start of the hour after the instant, also when it is exactly on the hour."""
    return F.timestamp_add("HOUR", F.lit(1), F.date_trunc("hour", F.col(ts)))


def views_and_applications(views: DataFrame, applications: DataFrame, from_date: str | None = None) -> DataFrame:
    """Per job and hour with a view or application: running counts, stamped with the next hour.

    ``views``: job_id, received_at (job id already resolved). ``applications``: job_id, created_at.
    A running count at the end of an hour is the sum of the hourly counts up to it, so both logs
    are stacked and counted per hour: no outer join, and windows over hours instead of events.
    """
    def log(df: DataFrame, ts: str, is_view: int) -> DataFrame:
        known = df.where(F.col("job_id").isNotNull())
        if from_date is not None:
            known = known.where(F.col(ts) >= F.lit(from_date).cast(dict(df.dtypes)[ts]))
        return known.select("job_id", next_hour(ts).alias("start_date"), F.lit(is_view).alias("view"))

    hourly = log(views, "received_at", 1).unionByName(log(applications, "created_at", 0)).groupBy(
        "job_id", "start_date"
    ).agg(F.sum("view").alias("__views"), F.sum(1 - F.col("view")).alias("__apps"))
    # bounded by the hours of the calendar
    sums = running(
        hourly, "job_id", "start_date", {"views": run_sum("__views"), "apps": run_sum("__apps")}, split=None
    )
    return sums.select(F.col("job_id").cast("string").alias("job_id"), "start_date", "views", "apps")


def resolve_external_jobs(views: DataFrame, jobs: DataFrame) -> DataFrame:
    """Views name jobs by their external id; answer them with the internal one, unknown jobs dropped."""
    return views.withColumnRenamed("job_id", "external_job_id").join(
        jobs.select("external_job_id", "job_id"), "external_job_id"
    ).select("job_id", "received_at")


def applicant_tracker(
    applications: DataFrame,
    jobs: DataFrame,
    requests: DataFrame,
    created_from: str | None = None,
    *,
    confirm_at_instant: bool = True,
    split: Split | None = SPLIT,
) -> DataFrame:
    """Per job and instant of change: applicants in force, of these requested and confirmed.

    ``applications``: user_id, job_id, applied_status_enum, applied_status_start_date, end_date.
    ``jobs``: job_id, job_created_at, job_start_date_time. ``requests``: user_id, job_id,
    request_created_at, request_confirmed_at. An application counts as requested from its request
    on, or from its start if that is less than two days before the job. Confirmations count from
    their own instant; ``confirm_at_instant=False`` counts them from the request on.

    Each application turns into signed changes and the counts are running sums, which replaces the
    pairing of every instant with every application in force.
    """
    if created_from is not None:
        jobs = jobs.where(F.col("job_created_at") >= F.lit(created_from).cast(dict(jobs.dtypes)["job_created_at"]))
    jobs = jobs.select("job_id", "job_created_at", "job_start_date_time")
    confirmed = F.col("request_confirmed_at").isNotNull() & F.col("request_created_at").isNotNull()
    confirmed_from = (
        F.greatest("request_created_at", "request_confirmed_at") if confirm_at_instant else F.col("request_created_at")
    )
    requested = requests.groupBy("user_id", "job_id").agg(
        F.min("request_created_at").alias("requested_from"),
        F.min(F.when(confirmed, confirmed_from)).alias("confirmed_from"),
    )
    start, end = F.col("applied_status_start_date"), F.col("end_date")
    in_force = (
        applications.where((F.col("applied_status_enum") == 0) & (start < end))
        .join(jobs, "job_id")
        .join(requested, ["user_id", "job_id"], "left")
    )
    late = F.date_diff(F.col("job_start_date_time"), start) < 2

    def entry(at: Column, total: int, asked: int, sure: int) -> Column:
        return F.struct(
            at.alias("start_date"), F.lit(total).alias("d_total"), F.lit(asked).alias("d_requested"),
            F.lit(sure).alias("d_confirmed"), F.lit(0).alias("point"),
        )

    def since(column: str) -> Column:
        """When the flag begins to hold for the application; NULL if never before its end."""
        begins = F.when(late, start).when(F.col(column).isNotNull(), F.greatest(start, F.col(column)))
        return F.when(begins < end, begins)

    asked, sure = since("requested_from"), since("confirmed_from")
    steps = in_force.select(
        "job_id",
        F.explode(
            F.array(
                entry(start, 1, 0, 0),
                entry(end, -1, 0, 0),
                entry(asked, 0, 1, 0),
                entry(F.when(asked.isNotNull(), end), 0, -1, 0),
                entry(sure, 0, 0, 1),
                entry(F.when(sure.isNotNull(), end), 0, 0, -1),
            )
        ).alias("s"),
    ).select("job_id", "s.*").where(F.col("start_date").isNotNull())

    points = change_points(
        [
            applications.select("job_id", start.alias("start_date")),
            jobs.select("job_id", F.col("job_created_at").alias("start_date")),
            requests.select("job_id", F.col("request_created_at").alias("start_date")),
            requests.select("job_id", F.col("request_confirmed_at").alias("start_date")),
        ],
        "job_id",
        "start_date",
    ).join(jobs.select("job_id"), "job_id", "left_semi")
    nothing = F.lit(0)
    marks = points.select(
        "job_id", "start_date", nothing.alias("d_total"), nothing.alias("d_requested"),
        nothing.alias("d_confirmed"), F.lit(1).alias("point"),
    )
    instants = steps.unionByName(marks).groupBy("job_id", "start_date").agg(
        *[F.sum(c).alias(c) for c in ("d_total", "d_requested", "d_confirmed")], F.max("point").alias("point")
    )
    counted = running(
        instants, "job_id", "start_date",
        {"total_applicants": run_sum("d_total"), "requested": run_sum("d_requested"),
         "confirmed": run_sum("d_confirmed")},
        split=split, sized_by=[applications, requests],
    )
    return counted.where(F.col("point") == 1).select(
        F.col("job_id").cast("string").alias("job_id"), "start_date", "total_applicants", "requested", "confirmed"
    )


# Keywords looked for in the lower-cased schedule name, first match wins
SCHEDULE_BUCKETS = [
    ("1st shift", ("1st", "first")),
    ("2nd shift", ("2nd", "second")),
    ("3rd shift", ("3rd", "third")),
    ("morning", ("am shift", "morning")),
    ("night", ("night", "pm")),
    ("mon-fri", ("mon-fri", "mon - fri")),
]


def keyword_bucket(text: str, buckets: Sequence[tuple[str, Sequence[str]]], default: str = "other") -> Column:
    """First bucket one of whose keywords occurs in the lower-cased text."""
    lowered = F.lower(F.col(text))
    chosen = None
    for bucket, words in buckets:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(lowered, F.lit(word))
        chosen = F.when(hit, bucket) if chosen is None else chosen.when(hit, bucket)
    return F.lit(default) if chosen is None else chosen.otherwise(default)


def attach_group_stats(df: DataFrame, by: dict[str, Column], stats: dict[str, Column]) -> DataFrame:
    """Aggregates of a row's group as columns, by grouping and joining back.

    A window over the group would hold a hot group in one task; grouping combines it map-side, and
    the join back (NULL keys equal each other) has one row per group on its right.
    """
    keyed = df.withColumns({f"__g{i}": c for i, c in enumerate(by.values())})
    names = [f"__g{i}" for i in range(len(by))]
    grouped = keyed.groupBy(*names).agg(*[c.alias(n) for n, c in stats.items()])
    left, right = keyed.alias("l"), grouped.alias("r")
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    return left.join(right, same, "left").select(*[F.col(f"l.`{c}`") for c in df.columns], *[F.col(f"r.{n}") for n in stats])


def attach_nested_stats(
    df: DataFrame, outer: dict[str, Column], inner: dict[str, Column], unit: str,
    stats: dict[str, tuple[str, str, str | None]],
) -> DataFrame:
    """Aggregates of two nested groups of a row as columns, in one pass over the rows and one join back.

    Rows belong to a group of ``outer`` and within it to one of ``inner``; NULLs are values. ``stats``:
    ``{output: (group, kind, column)}`` with group "outer" or "inner" and kind "mean", "sum" or "units", the
    distinct values of ``unit``. Rows are combined per inner group and unit, a unit that is in several
    inner groups counts for the outer one in the first of them, and inner groups are summed up to outer ones.
    """
    over, within = [f"__o{k}" for k in range(len(outer))], [f"__i{k}" for k in range(len(inner))]
    keyed = df.withColumns(dict(zip([*over, *within], [*outer.values(), *inner.values()])))
    values = dict.fromkeys(column for _, kind, column in stats.values() if kind != "units")
    parts = {}
    for k, column in enumerate(values):
        parts |= {f"__sum{k}": F.sum(column), f"__n{k}": F.count(column)}
    names = dict(zip(values, range(len(values))))
    per_unit = keyed.groupBy(*over, *within, F.col(unit).alias("__unit")).agg(*[c.alias(n) for n, c in parts.items()])
    first = F.row_number().over(Window.partitionBy(*over, "__unit").orderBy(*within)) == 1
    known = F.col("__unit").isNotNull()
    counted = per_unit.withColumn("__outer_units", (known & first).cast("int")).withColumn("__inner_units", known.cast("int"))
    sums = [*parts, "__outer_units", "__inner_units"]
    groups = counted.groupBy(*over, *within).agg(*[F.sum(c).alias(c) for c in sums])
    whole = Window.partitionBy(*over)
    totals = groups.withColumns({f"{c}_of": F.sum(c).over(whole) for c in sums})

    def stat(group: str, kind: str, column: str | None) -> Column:
        tail = "_of" if group == "outer" else ""
        if kind == "units":
            return F.col(f"__{group}_units{tail}")
        total, n = F.col(f"__sum{names[column]}{tail}"), F.col(f"__n{names[column]}{tail}")
        return total if kind == "sum" else F.when(n > 0, total / n)

    told = totals.select(*over, *within, *[stat(*s).alias(out) for out, s in stats.items()])
    left, right = keyed.alias("l"), told.alias("r")
    same = F.lit(True)
    for n in [*over, *within]:
        same = same & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
    return left.join(right, same, "left").select(*[F.col(f"l.`{c}`") for c in df.columns], *[F.col(f"r.{n}") for n in stats])


def located_jobs(jobs: DataFrame, zip_counties: DataFrame, created_from: str | None = None) -> DataFrame:
    """Jobs with the county of their zip code."""
    if created_from is not None:
        jobs = jobs.where(F.col("job_created_at") >= F.lit(created_from).cast(dict(jobs.dtypes)["job_created_at"]))
    counties = zip_counties.groupBy(F.col("zip").alias("job_zipcode")).agg(F.min("county").alias("county"))
    return jobs.join(counties, "job_zipcode", "left")


def market_stats(located: DataFrame) -> DataFrame:
    """Job rows with their wage against its county / type / title / month, and monthly demand.

    ``located``: job_id, county, job_created_at, job_start_date_time, job_type, job_title, job_wage,
    schedule_name, job_needed_last_count, invited_worker_count and whatever else should pass through.
    """
    compared = attach_nested_stats(
        located,
        {"county": F.col("county"), "year": F.year("job_created_at"), "month": F.month("job_created_at")},
        {"type": F.col("job_type"), "title": F.col("job_title")},
        "job_id",
        {
            "county_job_type_title_avg_wage": ("inner", "mean", "job_wage"),
            "job_type_title_count": ("inner", "units", None),
            "total_job_count": ("outer", "units", None),
            "total_cms_required": ("outer", "sum", "job_needed_last_count"),
        },
    )
    average = F.col("county_job_type_title_avg_wage")
    return compared.withColumns(
        {
            "wage_delta": F.col("job_wage") - average,
            "wage_delta_percent": percent_delta("job_wage", average),
            "invited_worker_count": F.coalesce("invited_worker_count", F.lit(0)),
            "schedule_name_updated": keyword_bucket("schedule_name", SCHEDULE_BUCKETS),
            "posting_lead_time_days": complete_units("DAY", "job_created_at", "job_start_date_time"),
            "cm_count_ratio": ratio("total_cms_required", "total_job_count"),
        }
    )


def activity_days(logs: Sequence[DataFrame], since: str | None = None, strict: bool = False) -> DataFrame:
    """Distinct (user_id, session) of several app logs; a session is a day, or the raw instant if strict.

    ``logs``: internal_id, original_timestamp each.
    """
    sessions = []
    for log in logs:
        kind = dict(log.dtypes)["original_timestamp"]
        if since is not None:
            log = log.where(F.col("original_timestamp") >= F.lit(since).cast(kind))
        at = F.col("original_timestamp") if strict else F.date_trunc("day", "original_timestamp").cast(kind)
        sessions.append(log.select(F.col("internal_id").alias("user_id"), at.alias("session")))
    stacked = sessions[0]
    for more in sessions[1:]:
        stacked = stacked.unionByName(more)
    return stacked.where(F.col("user_id").isNotNull()).distinct()


def presence_changes(
    status: DataFrame, sessions: DataFrame, active_days: int = 7,
    *, split: Split | None = SPLIT,
) -> DataFrame:
    """Signed changes of a user's state: d_eligible (status 1) and d_active (any status and a recent session).

    ``status``: user_id, user_status_enum, start_date, end_date, in force for start < t <= end;
    status 0 does not count. A session keeps its user active for start <= t < start + active_days.
    All bounds are brought to "from this instant on" at microsecond grain.
    """
    tick = F.lit(1)
    in_force = status.where((F.col("user_status_enum") != 0) & (F.col("start_date") < F.col("end_date")))
    one = F.when(F.col("user_status_enum") == 1, 1).otherwise(0)
    status_steps = in_force.select(
        "user_id",
        F.explode(
            F.array(
                F.struct(F.timestamp_add("MICROSECOND", tick, F.col("start_date")).alias("at"),
                         F.lit(1).alias("any"), one.alias("eligible"), F.lit(0).alias("recent")),
                F.struct(F.timestamp_add("MICROSECOND", tick, F.col("end_date")).alias("at"),
                         F.lit(-1).alias("any"), (-one).alias("eligible"), F.lit(0).alias("recent")),
            )
        ).alias("s"),
    ).select("user_id", "s.*")
    session_steps = sessions.select(
        "user_id",
        F.explode(
            F.array(
                F.struct(F.col("session").alias("at"), F.lit(0).alias("any"), F.lit(0).alias("eligible"),
                         F.lit(1).alias("recent")),
                F.struct(F.timestamp_add("DAY", F.lit(active_days), F.col("session")).alias("at"),
                         F.lit(0).alias("any"), F.lit(0).alias("eligible"), F.lit(-1).alias("recent")),
            )
        ).alias("s"),
    ).select("user_id", "s.*")
    steps = ("any", "eligible", "recent")
    instants = status_steps.unionByName(session_steps).groupBy("user_id", "at").agg(
        *[F.sum(c).alias(f"d_{c}") for c in steps]
    )
    counts = running(
        instants, "user_id", "at", {c: run_sum(f"d_{c}") for c in steps}, split=split, sized_by=[status, sessions]
    )

    def state(after: bool) -> tuple[Column, Column]:
        held, eligible, recent = (F.col(c) if after else F.col(c) - F.col(f"d_{c}") for c in steps)
        return (eligible > 0).cast("int"), ((held > 0) & (recent > 0)).cast("int")

    (is_eligible, is_active), (was_eligible, was_active) = state(True), state(False)
    return counts.select(
        "user_id",
        "at",
        (is_eligible - was_eligible).alias("d_eligible"),
        (is_active - was_active).alias("d_active"),
    ).where((F.col("d_eligible") != 0) | (F.col("d_active") != 0))


# Radii in miles
RADII_MILES = (1, 5, 10, 15)


JOB_AT = ("job_address_latitude", "job_address_longitude")
USER_AT = ("user_address_latitude", "user_address_longitude")


def micros(at: str) -> Column:
    return F.unix_micros(F.col(at).cast("timestamp"))


def count_names(radii: Sequence[float]) -> list[str]:
    near = [f"{kind}_cms_{r}_mile" for kind in ("eligible", "active") for r in radii]
    return ["eligible_users", "active_users_7_days", *near]


def supply_counts(
    located: DataFrame, users: DataFrame, changes: DataFrame, radii: Sequence[float] = RADII_MILES,
    *, split: Split | None = SPLIT, crowd: int = CROWD,
) -> DataFrame:
    """Eligible and active users of a job's county at its creation, in all and within each radius.

    ``located``: job_id, county, job_created_at, job_address_latitude / _longitude. ``users``:
    user_id, county, user_address_latitude / _longitude. ``changes``: see ``presence_changes``.
    One row per county, job site and instant of creation.

    Counts in force are sums of the changes up to the creation: per county as running sums that are looked up, within
    the radii over the sites around a job, which form no rows with it (see ``sums_within``; ``crowd`` is its).
    """
    kind = dict(located.dtypes)["job_created_at"]
    deltas = (
        changes.join(users.where(F.col("county").isNotNull()).select("user_id", "county", *USER_AT), "user_id")
        .groupBy("county", *USER_AT, F.col("at").cast(kind).alias("at"))
        .agg(F.sum("d_eligible").alias("d_eligible"), F.sum("d_active").alias("d_active"))
    )
    deltas = stage(deltas)  # counted by county and by distance
    outputs = {"eligible": "d_eligible", "active": "d_active"}
    county_split = if_hot(split, [located, deltas], ["county"])
    by_county = in_force_counts(deltas, ["county"], "at", outputs, split=county_split)
    spots = stage(
        located.select("county", *JOB_AT, "job_created_at").distinct().withColumn("spot", F.monotonically_increasing_id())
    )
    county_wide = asof_join(
        spots, by_county, "county", "job_created_at", "at",
        {"eligible": "eligible_users", "active": "active_users_7_days"},
        split=county_split, left_rows=located, right_rows=deltas,
    )
    nearby = sums_within(
        spots.withColumn("__created", micros("job_created_at")), deltas.withColumn("__at", micros("at")), "spot", JOB_AT, USER_AT, radii,
        list(outputs.values()), by=["county"], time=("__created", "__at"), crowd=crowd,
    ).withColumnsRenamed({f"{d}_{r}": f"{state}_cms_{r}_mile" for state, d in outputs.items() for r in radii})
    return county_wide.join(nearby, "spot", "left").fillna(0, count_names(radii)).drop("spot")


def attach_supply(jobs: DataFrame, supply: DataFrame, radii: Sequence[float]) -> DataFrame:
    same = F.lit(True)
    for c in ("county", *JOB_AT, "job_created_at"):
        same = same & F.col(f"j.{c}").eqNullSafe(F.col(f"s.{c}"))
    return jobs.alias("j").join(supply.alias("s"), same, "left").select(
        *[F.col(f"j.`{c}`") for c in jobs.columns], *[F.col(f"s.{n}") for n in count_names(radii)]
    )


def users_with_county(users: DataFrame, zip_counties: DataFrame) -> DataFrame:
    counties = zip_counties.groupBy(F.col("zip").alias("user_zipcode")).agg(F.min("county").alias("county"))
    return users.join(counties, "user_zipcode", "left")


def job_market(
    jobs: DataFrame, zip_counties: DataFrame, users: DataFrame, status: DataFrame, logs: Sequence[DataFrame],
    created_from: str | None = None, activity_from: str | None = None, *,
    radii: Sequence[float] = RADII_MILES, strict: bool = False,
    split: Split | None = SPLIT,
) -> DataFrame:
    """Job attributes at creation: market wage, demand, and eligible and active users by radius."""
    located = located_jobs(jobs, zip_counties, created_from)
    changes = presence_changes(status, activity_days(logs, activity_from, strict), split=split)
    supply = supply_counts(located, users_with_county(users, zip_counties), changes, radii, split=split)
    supplied = attach_supply(market_stats(located), supply, radii)
    return supplied.drop("job_zipcode").withColumn("job_id", F.col("job_id").cast("string"))


# Columns the wide form takes from the statistics; all others come raw from the jobs
WIDE_STATISTICS = (
    "county_job_type_title_avg_wage", "job_type_title_count", "total_job_count", "total_cms_required",
    "wage_delta", "wage_delta_percent", "schedule_name_updated", "county", "posting_lead_time_days",
    "cm_count_ratio",
)


def job_market_wide(
    jobs: DataFrame, zip_counties: DataFrame, users: DataFrame, status: DataFrame, logs: Sequence[DataFrame],
    detail_columns: Sequence[str], created_from: str | None = None, activity_from: str | None = None, *,
    radii: Sequence[float] = RADII_MILES, strict: bool = False, split: Split | None = SPLIT,
) -> DataFrame:
    """The same metrics on the job key, joined again with the job table for its raw columns."""
    market = job_market(
        jobs, zip_counties, users, status, logs, created_from, activity_from, radii=radii,
        strict=strict, split=split,
    )
    narrow = market.select("job_id", *WIDE_STATISTICS, *count_names(radii))
    details = jobs.select(F.col("job_id").cast("string").alias("job_id"), *detail_columns)
    return narrow.join(details, "job_id", "left")
