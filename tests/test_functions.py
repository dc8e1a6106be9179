import datetime as dt
import math

from pyspark.sql import functions as F

from tidemark.functions import (
    complete_units,
    cosine_similarity,
    epoch_to_timestamp,
    haversine_miles,
    is_us_holiday,
    local_time,
    minutes_between,
    percent_delta,
    ratio,
    safe_divide,
    week_vector,
)

from conftest import plan, rows, ts


def test_week_vector_on_all_inputs(spark):
    """Every start hour, end hour and day against the rule told hour by hour."""
    grid = spark.range(24 * 24 * 7).select(
        (F.col("id") % 24).cast("int").alias("s"), F.expr("cast(id div 24 % 24 as int)").alias("e"),
        F.expr("cast(id div 576 + 1 as int)").alias("d"),
    )
    got = grid.select("s", "e", "d", week_vector("s", "e", "d").alias("v")).collect()
    assert len(got) == 4032
    for s, e, d, v in got:
        worked, hour = [0] * 168, (d - 1) * 24 + s
        while True:
            worked[hour % 168] = 1
            hour += 1
            if hour % 24 == e:
                break
        assert v == worked, (s, e, d)


def test_safe_divide_and_ratio(frame):
    df = frame("n double, d double", (1.0, 2.0), (0.0, 2.0), (1.0, 0.0), (None, 1.0), (1.0, None))
    got = df.select(safe_divide("n", "d"), safe_divide("n", "d", null_on_zero_numerator=False), ratio("n", "d"))
    assert rows(got) == [(0.5, 0.5, 0.5), (None, 0.0, 0.0), (None, None, None), (None, None, None), (None, None, None)]


def test_cosine_of_empty_zero_and_null_vectors(frame):
    df = frame("a array<int>, b array<int>", ([1, 0], [1, 1]), ([], []), ([0, 0], [1, 1]), (None, [1]), ([2, 2], [1, 1]))
    got = [r[0] for r in df.select(cosine_similarity("a", "b")).collect()]
    assert got[1:4] == [None, None, None]
    assert math.isclose(got[0], 1 / math.sqrt(2), rel_tol=1e-6) and math.isclose(got[4], 1.0, rel_tol=1e-6)
    assert "Python" not in plan(df.select(cosine_similarity("a", "b")))


def test_haversine_equal_points_antipodes_and_nulls(frame):
    df = frame("a double, b double, c double, d double", (10.0, 20.0, 10.0, 20.0), (12.3, 45.6, -12.3, -134.4), (None, 0.0, 0.0, 0.0))
    same, far, none = [r[0] for r in df.select(haversine_miles("a", "b", "c", "d")).collect()]
    assert same == 0.0 and math.isclose(far, 3959 * math.pi, rel_tol=1e-6) and none is None


def test_half_hour_zone_and_whole_units(frame):
    df = frame("s bigint, o int", (1_704_067_200, 330))
    local = df.select(local_time(epoch_to_timestamp("s"), "o").cast("string")).first()[0]
    assert local == "2023-12-31 18:30:00"
    pair = frame("a timestamp_ntz, b timestamp_ntz", (ts("2024-01-08T00:00:01"), ts("2024-01-02T00:00:02")))
    assert rows(pair.select(complete_units("DAY", "a", "b"), minutes_between("b", "a"))) == [(-5, 8639 + 59 / 60)]


def test_percent_delta_guards_zero_base(frame):
    df = frame("v double, b double", (3.0, 2.0), (3.0, 0.0), (3.0, -1.0))
    assert [r[0] for r in df.select(percent_delta("v", "b")).collect()] == [50.0, 0.0, 0.0]


def test_holidays_of_single_years(spark):
    days = spark.sql("SELECT explode(sequence(date'2020-12-01', date'2022-12-31', interval 1 day)) AS d")
    got = {r.d for r in days.where(is_us_holiday("d")).collect()}
    expected_2021 = {
        (1, 1), (1, 18), (2, 15), (5, 31), (6, 18), (6, 19), (7, 4), (7, 5), (9, 6), (10, 11), (11, 11), (11, 25),
        (12, 24), (12, 25), (12, 31),  # the last one stands in for New Year 2022, a Saturday
    }
    assert {(x.month, x.day) for x in got if x.year == 2021} == expected_2021
    assert dt.date(2020, 12, 25) in got and dt.date(2022, 12, 26) in got
    assert dt.date(2021, 6, 18) not in {r.d for r in days.where(is_us_holiday("d", observed=False)).collect()}
