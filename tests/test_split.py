"""Every pipeline that splits hot keys gives the same rows with and without the splitting."""

import os

import pytest
from pyspark.sql import functions as F

from suite.base import Data
from tidemark.functions import cosine_similarity
from tidemark.operators.hot import Split
from tidemark.plans import jobs, people, shifts, training
from tidemark.sources.tables import FeatureTable

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def similarity(d, split):
    users = FeatureTable(
        "users", shifts.user_schedule(d.shifts, split=split), ("user_id", "calendar_date"), "calendar_date", rows=d.shifts
    )
    lookup = training.Lookup(users, "cancel_user_id", "cancel_created_at")
    cosine = training.Derived(cosine_similarity, "c", {"left": "running_schedule_array", "right": "running_schedule_array"})
    return training.build_training_set(d.cancel_labels, [lookup, cosine], split=split)


PIPELINES = {
    "work_history": lambda d, split: people.work_history(
        d.segments, d.event_jobs, d.needed_periods, d.applications, d.worked_pairs, "2024-03-01", split=split
    ),
    "ratings": lambda d, split: people.user_ratings(d.ratings, d.dont_send, d.favorites, split=split),
    "certifications": lambda d, split: people.user_certifications(d.certifications, split=split),
    "applicants": lambda d, split: jobs.applicant_tracker(d.applications, d.event_jobs, d.requests, split=split),
    "history": lambda d, split: jobs.value_change_history(
        d.needed_current, d.needed_edits, "needed", prefer=["edit_id"], split=split
    ),
    "similarity": similarity,
}


@pytest.mark.parametrize("name", PIPELINES)
def test_split_changes_nothing(spark, name):
    d = Data(spark, FOLDER)
    plain = PIPELINES[name](d, None)
    # about a third of the keys are above the threshold, and their days too
    split = PIPELINES[name](d, Split(hot_rows=8, unit="week"))
    columns = plain.columns
    as_text = [F.col(c).cast("string").alias(c) for c in columns]
    ours = sorted(map(str, split.select(*as_text).collect()))
    assert ours and ours == sorted(map(str, plain.select(*as_text).collect()))
