"""Pipelines on hand-written rows: the edge cases a generated table does not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import safe_divide
from tidemark.operators.hot import Split
from tidemark.plans import jobs, people, shifts, training
from tidemark.plans.calendar import calendar
from tidemark.sources.tables import FeatureTable

from conftest import plan, rows, ts

OPEN = ts("2099-01-01")


def epoch(text):
    return int(ts(text).replace(tzinfo=dt.timezone.utc).timestamp())


@pytest.fixture
def work(frame):
    segments = frame(
        "job_id int, segment_index int, start_time bigint, end_time bigint, start_time_offset int, active boolean, created_at timestamp_ntz",
        (1, 2, epoch("2024-01-10T08:00:00"), 0, 0, True, ts("2024-01-01")),
        (1, 1, epoch("2024-01-09T08:00:00"), 0, 0, False, ts("2024-01-01")),  # inactive
        (1, 0, epoch("2024-01-08T08:00:00"), 0, 0, True, ts("2024-01-09")),  # created after its start
        (2, 1, epoch("2024-01-12T08:00:00"), 0, 0, True, ts("2024-01-01")),
        (3, 1, epoch("2024-01-13T08:00:00"), 0, 0, True, ts("2024-01-01")),  # invitations fill it
        (4, 1, epoch("2024-01-10T08:00:00"), 0, 0, True, ts("2024-01-01")),  # starts with job 1
        (5, 1, epoch("2024-01-15T08:00:00"), 0, 0, True, ts("2024-01-01")),
        (6, 1, epoch("2024-01-16T08:00:00"), 0, 0, True, ts("2024-01-01")),
    )
    job = frame(
        "job_id int, job_needed_original_count int, invited_worker_count int",
        (1, 5, None), (2, 5, 0), (3, 5, 5), (4, 5, 4), (5, 0, 3), (6, 5, None),
    )
    needed = frame(
        "job_id int, needed int, start_date timestamp_ntz, end_date timestamp_ntz",
        (5, 2, ts("2024-01-01"), ts("2024-01-15T08:00:00")), (5, 9, ts("2024-01-15T08:00:00"), OPEN),
    )
    return segments, job, needed


def test_work_history_outcomes(frame, work):
    segments, job, needed = work
    a = ts("2024-01-02")
    applications = frame(
        "user_id int, job_id int, applied_status_enum int, applied_status_start_date timestamp_ntz, end_date timestamp_ntz",
        (7, 1, 0, a, OPEN),  # worked
        (7, 2, 0, a, ts("2024-01-11T16:00:00")),  # exactly 16 h before: SNC
        (7, 4, 0, a, ts("2024-01-10T08:00:00")),  # ends at the start: no cancel, ties with job 1
        (7, 5, 0, a, ts("2024-01-03")),  # early; kept only because 9 are needed from the boundary on
        (7, 3, 0, a, OPEN),  # job out
        (7, 6, 0, a, None),  # no end, no outcome
        (8, 1, 1, a, OPEN),  # not successful
        (8, 2, 0, ts("2024-01-13"), OPEN),  # applied after the start
    )
    worked = frame("user_id int, job_id int", (7, 1), (7, 1))
    got = people.work_history(segments, job, needed, applications, worked, "2024-02-01")
    table = [
        (r.job_start_time.day, r.total_tracker, r.worked_ratio_all, r.no_cancel_ratio_all, r.snc_ratio_all,
         r.early_cancel_ratio_all, r.worked_ratio_ncns)
        for r in got.orderBy("job_start_time").collect()
    ]
    assert table == [
        (10, 2, 0.5, 0.5, 0.0, 0.0, 0.5),
        (12, 3, 1 / 3, 1 / 3, 1 / 3, 0.0, 0.5),
        (15, 4, 0.25, 0.25, 0.25, 0.25, 0.5),
        (16, 4, 0.25, 0.25, 0.25, 0.25, 0.5),
    ]
    assert {r.user_id for r in got.collect()} == {"7"}


def test_work_history_zero_denominators_are_null(frame, work):
    segments, job, needed = work
    applications = frame(
        "user_id int, job_id int, applied_status_enum int, applied_status_start_date timestamp_ntz, end_date timestamp_ntz",
        (7, 6, 0, ts("2024-01-02"), None),
    )
    worked = frame("user_id int, job_id int", (9, 9))
    row = people.work_history(segments, job, needed, applications, worked, "2024-02-01").first()
    assert (row.total_tracker, row.worked_ratio_all, row.worked_ratio_ncns) == (0, None, None)


def test_hours_calendar_uses_yesterday_and_stops_in_time(frame):
    shift = frame(
        "user_id int, job_id int, segment_id int, shift_start timestamp_ntz, job_wage double",
        (1, 10, 1, ts("2024-01-01T00:00:00"), 10.0), (1, 10, 2, ts("2024-01-01T09:00:00"), 20.0),
        (1, 11, 3, ts("2024-01-03T09:00:00"), 30.0),
    )
    got = shifts.hours_calendar(shift, shift, "2024-12-31", extend_days=2)
    assert [(str(r.calendar_date), r.shifts_worked_total, r.jobs_worked_total, r.avg_wage_total) for r in got.orderBy("calendar_date").collect()] == [
        ("2024-01-02", 2, 1, 15.0), ("2024-01-03", 2, 1, 15.0), ("2024-01-04", 3, 2, 22.5), ("2024-01-05", 3, 2, 22.5),
    ]
    assert shifts.hours_calendar(shift, shift, "2024-01-03").count() == 2
    fiscal = frame("start_date date, end_date date", (dt.date(2024, 1, 1), dt.date(2024, 1, 3)))
    assert shifts.hours_calendar(shift, shift, "2024-12-31", periods=fiscal).count() == 2
    assert shifts.hours_calendar(shift, shift, "2024-12-31", extend_days=2, from_date="2024-01-04").count() == 2
    text = plan(got)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_cancellation_calendar_starts_on_the_first_day(frame):
    missed = frame("user_id int, segment_id int, no_show_shift_start_time_utc timestamp_ntz", (1, 5, ts("2024-01-03T10:00:00")), (None, 6, ts("2024-01-03")))
    cancelled = frame("user_id int, snc_index int, cancel_timestamp_utc timestamp_ntz", (1, 1, ts("2024-01-01T23:00:00")), (1, 1, ts("2024-01-01T23:30:00")), (2, 2, ts("2024-01-01")))
    got = people.snc_ncns_calendar(missed, cancelled).orderBy("user_id", "calendar_date").collect()
    assert [(r.user_id, r.calendar_date.day, r.ncns_event, r.snc_event, r.snc_shifts_total, r.ncns_shifts_last_30_days) for r in got] == [
        ("1", 1, 0, 1, 1, 0), ("1", 2, 0, 0, 1, 0), ("1", 3, 1, 0, 1, 1), ("2", 1, 0, 1, 1, 0),
    ]


def test_ratings_keep_three_valued_logic_and_multiplicity(frame):
    t = ts("2024-01-01")
    ratings = frame(
        "id int, user_id int, created_at timestamp_ntz, rating int, reason string",
        (1, 1, t, 5, None), (2, 1, t, 3, None), (3, 1, t, 3, "NOT the right fit"), (4, 1, ts("2024-01-02"), 1, "late"),
    )
    dns = frame("rating_id int, created_at timestamp_ntz", (1, t), (1, t), (4, None))
    fav = frame("user_id int, created_at timestamp_ntz", (1, t))
    got = rows(people.user_ratings(ratings, dns, fav).drop("user_id"), "event_time_stamp")
    # rating 1 is met twice by the do-not-send log; 2 is dropped for its missing reason, 3 for its text
    assert got == [(t, 5.0, 2, 2), (ts("2024-01-02"), 3.67, 2, 2)]


def test_certifications_stick_after_the_first_column_too(frame):
    certs = frame(
        "user_id int, cert_completed_on timestamp_ntz, cert_name string, cert_verified int",
        (1, ts("2024-01-01"), "food", 1), (1, ts("2024-01-02"), "lift (A)", 1), (1, ts("2024-01-03"), "food", 0),
        (0, ts("2024-01-03"), "food", 1),
    )
    names = ["food", "lift (A)"]
    got = people.user_certifications(certs, names)
    assert got.columns == ["user_id", "cert_completed_on", "food", "liftA"]
    assert rows(got.select("food", "liftA", "cert_completed_on"), "cert_completed_on") == [
        (1, 0, ts("2024-01-01")), (1, 1, ts("2024-01-02")), (1, 1, ts("2024-01-03")),
    ]
    latest = people.user_certifications(certs, names, keep="last", split=Split(1, "day"))
    assert rows(latest.select("food", "liftA", "cert_completed_on"), "cert_completed_on")[2][:2] == (0, 1)
    with pytest.raises(ValueError):
        people.user_certifications(certs, names, keep="any")


def test_views_move_to_the_next_hour_also_on_the_hour(frame):
    views = frame("job_id int, received_at timestamp_ntz", (1, ts("2024-01-01T10:00:00")), (1, ts("2024-01-01T10:59:59")), (None, ts("2024-01-01")))
    applied = frame("job_id int, created_at timestamp_ntz", (1, ts("2024-01-01T12:30:00")))
    got = rows(jobs.views_and_applications(views, applied).withColumn("start_date", F.hour("start_date")), "start_date")
    assert got == [("1", 11, 2, 0), ("1", 13, 2, 1)]
    external = frame("external_job_id int, job_id int", (1, 77))
    assert rows(jobs.resolve_external_jobs(views, external).select("job_id")) == [(77,), (77,)]


def test_applicants_requests_and_confirmations(frame):
    job = frame("job_id int, job_created_at timestamp_ntz, job_start_date_time timestamp_ntz", (1, ts("2024-01-01"), ts("2024-01-20")))
    applied = frame(
        "user_id int, job_id int, applied_status_enum int, applied_status_start_date timestamp_ntz, end_date timestamp_ntz",
        (1, 1, 0, ts("2024-01-02"), ts("2024-01-10")), (2, 1, 0, ts("2024-01-19"), OPEN), (3, 1, 5, ts("2024-01-04"), OPEN),
        (4, 9, 0, ts("2024-01-02"), OPEN),
    )
    asked = frame(
        "user_id int, job_id int, request_created_at timestamp_ntz, request_confirmed_at timestamp_ntz",
        (1, 1, ts("2024-01-05"), ts("2024-01-07")), (1, 1, ts("2024-01-06"), None), (3, 1, None, None),
    )
    got = rows(jobs.applicant_tracker(applied, job, asked).select(F.dayofmonth("start_date"), "total_applicants", "requested", "confirmed"), "dayofmonth(start_date)")
    assert got == [(1, 0, 0, 0), (2, 1, 0, 0), (4, 1, 0, 0), (5, 1, 1, 0), (6, 1, 1, 0), (7, 1, 1, 1), (19, 1, 1, 1)]
    early = jobs.applicant_tracker(applied, job, asked, confirm_at_instant=False, split=Split(2, "day"))
    assert rows(early.where(F.dayofmonth("start_date") == 5).select("confirmed")) == [(1,)]


def test_value_history_keeps_listed_jobs(frame):
    current = frame("job_id int, overfill int", (1, 3), (2, 8))
    edits = frame("job_id int, old_overfill int, new_overfill int, created_at timestamp_ntz", (1, 2, 3, ts("2024-01-05")))
    got = jobs.value_change_history(current, edits, "overfill", jobs=frame("job_id int", (1,)))
    assert rows(got, "start_date") == [("1", 2, ts("2001-01-01")), ("1", 3, ts("2024-01-05"))]


def test_market_against_pairing_with_hot_counties(spark, frame):
    """Few users and jobs in one county, brute force over all pairs and instants."""
    import random

    dice = random.Random(4)
    at = lambda d: ts("2024-01-01T00:00:00") + dt.timedelta(days=d)
    users = [(u, "z", 40 + dice.random() / 4, -100 + dice.random() / 4) for u in range(12)]
    users += [(12, "z", users[0][2], users[0][3]), (13, "z", None, None), (14, None, 40.0, -100.0)]
    status, log = [], []
    for u, *_ in users:
        t = dice.randrange(10)
        while t < 60:
            end = t + 1 + dice.randrange(25)
            status.append((u, dice.randrange(3), at(t), at(end)))
            t = end
        log += [(u, at(dice.randrange(60)) + dt.timedelta(hours=dice.randrange(24))) for _ in range(6)]
    job = [(j, at(dice.randrange(60)), 40 + dice.random() / 4, -100 + dice.random() / 4) for j in range(30)]
    job += [(30, job[0][1], job[0][2], job[0][3]), (31, at(9), None, None)]
    jobs_df = spark.createDataFrame(job, "job_id int, job_created_at timestamp_ntz, job_address_latitude double, job_address_longitude double").withColumn("county", F.lit("C"))
    zips = frame("zip string, county string", ("z", "C"))
    users_df = jobs_module_users(spark, users, zips)
    status_df = spark.createDataFrame(status, "user_id int, user_status_enum int, start_date timestamp_ntz, end_date timestamp_ntz")
    log_df = spark.createDataFrame(log, "internal_id int, original_timestamp timestamp_ntz")
    for split, crowd in ((Split(5, "day"), 5), (None, 256)):
        changes = jobs.presence_changes(status_df, jobs.activity_days([log_df]), split=split)
        supply = jobs.supply_counts(jobs_df, users_df, changes, (1, 5, 10), split=split, crowd=crowd)
        got = jobs.attach_supply(jobs_df, supply, (1, 5, 10)).collect()
        assert len(got) == len(job)
        for r in got:
            t = r.job_created_at
            present = {u: s for u, s, a, b in status if s and a < t <= b and u != 14}
            active = {u for u in present if any(l == u and x.replace(hour=0) <= t < x.replace(hour=0) + dt.timedelta(days=7) for l, x in log)}
            eligible = {u for u, s in present.items() if s == 1}
            assert (r.eligible_users, r.active_users_7_days) == (len(eligible), len(active))
            for radius in (1, 5, 10):
                near = {u for u, _, la, lo in users if la and r.job_address_latitude and miles(la, lo, r.job_address_latitude, r.job_address_longitude) <= radius}
                assert r[f"eligible_cms_{radius}_mile"] == len(eligible & near)
                assert r[f"active_cms_{radius}_mile"] == len(active & near)


def test_market_counts_form_no_rows_of_jobs_and_sites(spark, frame):
    """A crowded town: jobs and users' changes meet as groups, and only sums leave them."""
    users_df = spark.range(300).select(
        F.col("id").alias("user_id"), F.lit("C").alias("county"),
        (40 + F.col("id") / 30000).alias("user_address_latitude"), F.lit(-100.0).alias("user_address_longitude"),
    )
    changes = users_df.select("user_id", F.lit(ts("2024-01-05")).alias("at"), F.lit(1).alias("d_eligible"), F.lit(1).alias("d_active"))
    jobs_df = spark.range(200).select(
        F.col("id").alias("job_id"), F.lit("C").alias("county"), F.lit(ts("2024-01-09")).alias("job_created_at"),
        (40 + F.col("id") / 30000).alias("job_address_latitude"), F.lit(-100.0).alias("job_address_longitude"),
    )
    supply = jobs.supply_counts(jobs_df, users_df, changes, (1, 5))
    assert "CoGroup" in plan(supply)
    counts = supply.agg(F.count("county"), F.min("eligible_cms_5_mile"), F.max("active_cms_5_mile"), F.max("eligible_users"))
    assert rows(counts) == [(200, 300, 300, 300)]


def jobs_module_users(spark, users, zips):
    df = spark.createDataFrame(users, "user_id int, user_zipcode string, user_address_latitude double, user_address_longitude double")
    return jobs.users_with_county(df, zips)


def miles(a, b, c, d):
    import math

    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 3959 * math.asin(math.sqrt(h))


def test_calendar_length(spark):
    got = calendar(spark, "2024-03-15")
    assert got.count() == 3651
    assert got.agg(F.countDistinct("date")).first()[0] == 3651


def test_funnel_latest_signup_and_null_stages(frame):
    funnel = frame(
        "user_id int, user_signup_date timestamp_ntz, eligible_date timestamp_ntz, first_shift_worked_date timestamp_ntz, etl_date timestamp_ntz",
        (1, ts("2024-01-01"), ts("2024-01-09"), None, None), (1, ts("2024-01-02T12:00:00"), None, ts("2024-01-03T00:00:00"), None),
        (2, None, None, None, ts("2024-01-01")), (None, ts("2024-01-01"), None, None, None),
    )
    row, = people.funnel_timeline(funnel).collect()
    assert (row.user_id, row.max_date, row.first_shift_worked_days, row.first_shift_worked_mins, row.eligible_days, row.ever_worked) == (
        "1", ts("2024-01-03"), 1, 720.0, None, 1,
    )


# --- training sets ----------------------------------------------------------------------------


@pytest.fixture
def parts(frame):
    labels = frame("id int, u int, t timestamp_ntz, y string", (1, 1, ts("2024-01-05"), "a"), (2, 1, ts("2023-12-31"), "b"), (3, None, ts("2024-01-05"), "c"))
    history = FeatureTable("h", frame("u string, at timestamp_ntz, v double, w double", ("1", ts("2024-01-05"), 4.0, 2.0), ("1", ts("2024-01-06"), 9.0, 9.0)), ("u", "at"), "at")
    return labels, history


def test_training_set_never_looks_ahead_and_keeps_rows(parts):
    labels, history = parts
    built = training.build_training_set(
        labels,
        [training.Derived(safe_divide, "q", {"numerator": "v", "denominator": "w"}), training.Lookup(history, "u", "t")],
        label="y", exclude_columns=["w"],
    )
    assert rows(built.select("id", "v", "q"), "id") == [(1, 4.0, 2.0), (2, None, None), (3, None, None)]
    assert "w" not in built.columns


def test_training_set_checks_its_parts(parts, frame):
    labels, history = parts
    lookup = training.Lookup(history, "u", "t", ("v",))
    with pytest.raises(ValueError, match="bind|argument|missing|unexpected"):
        training.build_training_set(labels, [lookup, training.Derived(safe_divide, "q", {"latitude": "v", "denominator": "v"})])
    with pytest.raises(ValueError, match="no columns"):
        training.build_training_set(labels, [lookup, training.Derived(safe_divide, "q", {"numerator": "v", "denominator": "nope"})])
    with pytest.raises(ValueError, match="label"):
        training.build_training_set(labels, [lookup], label="nope")
    with pytest.raises(ValueError, match="time key"):
        training.build_training_set(labels, [training.Lookup(history, "u")])
    with pytest.raises(ValueError, match="keyed by"):
        training.build_training_set(labels, [training.Lookup(history, ("u", "id"), "t")])
    with pytest.raises(ValueError, match="no columns"):
        training.build_training_set(labels, [training.Lookup(history, "u", "t", ("zzz",))])


def test_plain_lookup_and_column_pruning(spark, parts, frame, tmp_path):
    labels, history = parts
    flags = FeatureTable("f", frame("u int, flag int", (1, 1)), ("u",))
    built = training.build_training_set(labels, [training.Lookup(flags, "u", rename={"flag": "invited"})])
    assert rows(built.select("id", "invited"), "id") == [(1, 1), (2, 1), (3, None)]
    history.df.write.parquet(str(tmp_path / "h"))
    stored = FeatureTable("h", spark.read.parquet(str(tmp_path / "h")), ("u", "at"), "at")
    text = plan(training.build_training_set(labels, [training.Lookup(stored, "u", "t", ("v",))]))
    assert "ReadSchema: struct<u:string,at:timestamp_ntz,v:double>" in text


def test_certifications_are_found_or_refused_never_dropped(frame):
    certs = frame(
        "user_id int, cert_completed_on timestamp_ntz, cert_name string, cert_verified int",
        (1, ts("2024-01-01"), "forklift", 1), (1, ts("2024-01-02"), "new cert", 1),
    )
    assert people.user_certifications(certs).columns == ["user_id", "cert_completed_on", "forklift", "newcert"]
    with pytest.raises(ValueError, match="new cert"):
        people.user_certifications(certs, ["forklift"])
