"""Running measures: the split into blocks must not change a single value."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.hot import Split, find_hot_keys
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

from conftest import rows, ts

KINDS = {"sum": run_sum, "count": run_count, "max": run_max, "min": run_min, "last": run_last, "first": run_first}


@pytest.fixture(scope="module")
def log(spark):
    """One key owns a third of the rows; values have gaps, instants have ties."""
    dice = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{dice.randrange(60)}"
        at = ts("2024-01-01T00:00:00").replace(day=1 + dice.randrange(9), hour=dice.randrange(0, 24, 6))
        data.append((i, key, at, None if dice.random() < 0.4 else dice.randrange(100)))
    return spark.createDataFrame(data, "id int, k string, t timestamp_ntz, v int").cache()


@pytest.mark.parametrize("unit", ["day", "hour", "week"])
@pytest.mark.parametrize("rows_per_task", [10, 100])  # 10: units are cut further
def test_rows_frame_equals_plain_window(log, unit, rows_per_task):
    measures = {**{n: kind("v") for n, kind in KINDS.items()}, "prev": run_previous("id", F.lit(-1))}
    split = running(log, "k", "t", measures, ties=["id"], split=Split(rows_per_task, unit))
    plain = running(log, "k", "t", measures, ties=["id"], split=None)
    assert rows(split, "id") == rows(plain, "id")


def test_range_frame_gives_ties_one_value(log):
    measures = {n: KINDS[n]("v") for n in ("sum", "count", "max", "min")}
    split = running(log, "k", "t", measures, frame="range", split=Split(100, "day"))
    w = Window.partitionBy("k").orderBy("t")
    truth = log.select(
        "*", F.sum("v").over(w).alias("sum"), F.count("v").over(w).alias("count"),
        F.max("v").over(w).alias("max"), F.min("v").over(w).alias("min"),
    )
    assert rows(split, "id") == rows(truth, "id")


def test_hot_keys_are_counted_over_all_sources(log):
    assert [r.k for r in find_hot_keys([log], ["k"], 250).collect()] == ["hot"]
    assert find_hot_keys([log], ["k"], 350) is None
    assert [r.k for r in find_hot_keys([log, log], ["k"], 350).collect()] == ["hot"]


def test_null_keys_form_a_group_unless_spread(spark, frame):
    df = frame("k string, t timestamp_ntz, v int", (None, ts("2024-01-01"), 1), (None, ts("2024-01-02"), 2), ("a", ts("2024-01-01"), 5))
    kept = running(df, "k", "t", {"s": run_sum("v")}, split=Split(1, "day"))
    assert {(r.k, r.v): r.s for r in kept.collect()} == {(None, 1): 1, (None, 2): 3, ("a", 5): 5}


def test_rejects_unknown_frame(log):
    with pytest.raises(ValueError):
        running(log, "k", "t", {"s": run_sum("v")}, frame="groups")


def test_hot_path_reads_a_staged_copy_and_spreads_the_key(log):
    from conftest import plan

    text = plan(running(log, "k", "t", {"s": run_sum("v")}, ties=["id"], split=Split(100, "day")))
    assert "__block" in text and "staged-" in text
    assert "Nested" not in text and "Cartesian" not in text


def test_crowded_units_are_cut_by_their_rows(log):
    from tidemark.operators.hot import BLOCK, cut_hot_keys

    cut = cut_hot_keys(log, ["k"], "t", Split(30, "week"), [log])
    assert cut.hot.where("k = 'hot'").groupBy("k", BLOCK).count().count() >= 8
    assert cut.rest.where("k = 'hot'").count() == 0
    assert cut.hot.count() + cut.rest.count() == log.count()
    with pytest.raises(ValueError):
        Split(10, "month")


@pytest.mark.parametrize("hot_rows", [1, 70, 10**6])
def test_descending_ties_and_null_values_at_every_threshold(log, hot_rows):
    w = Window.partitionBy("k").orderBy("t", F.desc("id"))
    got = running(
        log, "k", "t", {"before": run_previous("v", F.lit(-1)), "latest": run_last("v"), "first": run_first("v")},
        ties=[F.desc("id")], split=Split(hot_rows, "day"),
    )
    until = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    truth = log.select(
        "*", F.lag("v", 1, -1).over(w).alias("before"), F.last("v", True).over(until).alias("latest"),
        F.first("v", True).over(until).alias("first"),
    )
    assert rows(got, "id") == rows(truth, "id")


def test_known_hot_keys_are_not_counted_again(log, spark):
    from tidemark.operators.hot import if_hot

    split = if_hot(Split(100, "day"), [log], ["k"])
    assert [r.k for r in split.hot.collect()] == ["hot"] and if_hot(Split(400, "day"), [log], ["k"]) is None
    got = running(log.withColumnRenamed("k", "key"), "key", "t", {"s": run_sum("v")}, ties=["id"], split=split)
    plain = running(log.withColumnRenamed("k", "key"), "key", "t", {"s": run_sum("v")}, ties=["id"], split=None)
    assert rows(got, "id") == rows(plain, "id")
