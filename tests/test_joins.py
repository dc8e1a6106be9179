import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, key_lookup
from tidemark.operators.hot import Split
from tidemark.operators.intervals import interval_join, lookback_days, valid_at
from tidemark.operators.radius import near_places
from tidemark.operators.spine import entity_days, hour_grid

from conftest import plan, rows, ts


def brute_asof(labels, features, strict=False):
    out = []
    for i, k, t in labels:
        best = None
        for fk, ft, v in features:
            if k is not None and fk == k and (ft < t if strict else ft <= t) and (best is None or ft > best[0]):
                best = (ft, v)
        out.append((i, None if best is None else best[1]))
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_asof_against_brute_force(spark, strict, hot_rows):
    dice = random.Random(3)

    def instant():
        return ts("2024-01-01T00:00:00").replace(day=1 + dice.randrange(5), hour=dice.randrange(24))

    labels = [(i, dice.choice(["a", "a", "b", "c", None]), instant()) for i in range(150)]
    features = [(k, t, i) for i, (k, t) in enumerate({(dice.choice(["a", "a", "b", "d"]), instant()) for _ in range(80)})]
    left = spark.createDataFrame(labels, "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame(features, "k string, at timestamp_ntz, v int")
    got = asof_join(left, right, "k", "t", "at", ["v"], strict=strict, split=Split(hot_rows, "day"))
    assert rows(got.select("id", "v"), "id") == brute_asof(labels, features, strict)
    assert got.count() == len(labels)


def test_asof_is_one_shuffle_without_joins(frame):
    left = frame("k int, t timestamp_ntz", (1, ts("2024-01-02")))
    right = frame("k int, at timestamp_ntz, v int", (1, ts("2024-01-01"), 7))
    text = plan(asof_join(left, right, "k", "t", "at"))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_asof_casts_the_lookup_key_and_refuses_name_clashes(frame):
    left = frame("k int, t timestamp_ntz, v int", (1, ts("2024-01-02"), 0))
    right = frame("k string, at timestamp_ntz, v int", ("1", ts("2024-01-01"), 7))
    assert rows(asof_join(left, right, "k", "t", "at", {"v": "w"}).select("w")) == [(7,)]
    with pytest.raises(ValueError):
        asof_join(left, right, "k", "t", "at")


def test_shared_interval_boundary(frame):
    """Closed ends match both neighbours; half-open ends exactly one."""
    points = frame("k int, t timestamp_ntz", (1, ts("2024-01-02")))
    history = frame(
        "k int, a timestamp_ntz, b timestamp_ntz, s string",
        (1, ts("2024-01-01"), ts("2024-01-02"), "old"), (1, ts("2024-01-02"), ts("2099-01-01"), "new"),
    )
    closed = interval_join(points, history, "k", "t", "a", "b", bounds="[]")
    assert rows(closed.select("s"), "s") == [("new",), ("old",)]
    assert rows(valid_at(points, history, "k", "t", "a", "b", ["s"]).select("s")) == [("new",)]
    assert rows(valid_at(points, history, "k", "t", "a", "b", ["s"], bounds="(]").select("s")) == [("old",)]


def test_interval_join_finds_overlapping_intervals(spark):
    dice = random.Random(5)
    day = lambda n: ts("2024-01-01T00:00:00").replace(day=1 + n // 24, hour=n % 24)
    points = [(i, dice.choice("ab"), day(dice.randrange(240))) for i in range(60)]
    spans = []
    for i in range(40):
        a = dice.randrange(200)
        spans.append((i, dice.choice("ab"), day(a), day(a + dice.randrange(40))))
    left = spark.createDataFrame(points, "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame(spans, "sid int, k string, a timestamp_ntz, b timestamp_ntz")
    for bounds in ("[)", "(]", "[]", "()"):
        lo = (lambda x, y: x <= y) if bounds[0] == "[" else (lambda x, y: x < y)
        hi = (lambda x, y: x <= y) if bounds[1] == "]" else (lambda x, y: x < y)
        truth = sorted((i, s) for i, k, t in points for s, sk, a, b in spans if k == sk and lo(a, t) and hi(t, b))
        got = interval_join(left, right, "k", "t", "a", "b", bounds=bounds).select("id", "sid")
        assert rows(got, "id", "sid") == truth
        assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_lookback_counts_whole_days(frame):
    """A day counts from its midnight until seven whole days have passed."""
    labels = frame("id int, u int, t timestamp_ntz", (1, 1, ts("2024-01-08T00:00:00")), (2, 1, ts("2024-01-07T23:59:59")))
    days = frame("u int, d timestamp_ntz", (1, ts("2024-01-01")), (1, ts("2024-01-08")), (1, ts("2024-01-09")))
    got = lookback_days(labels, days, "u", "t", "d").select("id", F.dayofmonth("event_day"))
    assert rows(got, "id") == [(1, 8), (2, 1)]


def test_key_lookup_keeps_rows_and_null_keys(frame):
    left = frame("id int, k int", (1, 1), (2, 9), (3, None))
    right = frame("k string, v string", ("1", "x"))
    assert rows(key_lookup(left, right, "k"), "id") == [(1, 1, "x"), (2, 9, None), (3, None, None)]


def test_entity_days_bounds_and_empty_span(frame):
    df = frame("u int, a timestamp_ntz, b timestamp_ntz", (1, ts("2024-02-28T23:00:00"), ts("2024-03-01T01:00:00")), (2, ts("2024-03-02"), ts("2024-03-01")))
    got = entity_days(df, "u", F.col("a"), F.col("b"))
    assert [str(r.calendar_date) for r in got.orderBy("calendar_date").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert "Join" not in plan(got)


def test_hour_grid_length(spark):
    assert hour_grid(spark, "2020-01-01 00:00:00", "2026-01-01 00:00:00").count() == 52_609


def test_near_places_at_the_pole_and_the_date_line(frame):
    left = frame("i int, a double, b double", (1, 89.95, 10.0), (2, 0.0, 179.95), (3, 40.0, -100.0), (4, None, 1.0))
    right = frame("j int, x double, y double", (1, 89.95, -170.0), (2, 0.0, -179.95), (3, 40.1, -100.0), (4, 50.0, -100.0))
    got = near_places(left, right, ("a", "b"), ("x", "y"), "j", [5, 15]).near
    assert rows(got.select("i", "place", "reach"), "i") == [(1, 1, 15.0), (2, 2, 15.0), (3, 3, 15.0)]
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


@pytest.mark.parametrize("crowd", [20, 10**6])
def test_near_places_cover_each_near_site_once(spark, crowd):
    """A dense town: whole cubes stand for their sites, and every site is reached exactly once."""
    dice = random.Random(9)
    sites = [(j, 40 + dice.gauss(0, 0.05), -100 + dice.gauss(0, 0.05)) for j in range(400)]
    points = [(i, 40 + dice.uniform(-0.3, 0.3), -100 + dice.uniform(-0.3, 0.3)) for i in range(25)]
    radii = [1, 5, 10, 15]
    left = spark.createDataFrame(points, "i int, a double, b double")
    right = spark.createDataFrame(sites, "j int, x double, y double")
    places = near_places(left, right, ("a", "b"), ("x", "y"), "j", radii, crowd=crowd, depth=4)
    near, members = places.near.cache(), places.members
    if crowd < 100:
        assert near.where("level >= 0").count() > 0
        assert near.count() < near.join(members, ["level", "place"]).count()
    got = sorted(rows(near.join(members, ["level", "place"]).select("i", "site", "reach")))

    def miles(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 3959 * math.asin(math.sqrt(h))

    truth = []
    for i, a, b in points:
        for j, x, y in sites:
            fits = [float(r) for r in radii if miles(a, b, x, y) <= r]
            if fits:
                truth.append((i, j, fits[0]))
    assert got == sorted(truth)


def test_valid_at_ignores_empty_intervals_whatever_the_order(frame):
    points = frame("k int, t int", (1, 5), (1, 4), (1, 9))
    spans = [(1, 4, 4, 1), (1, 4, 9, 2), (1, 5, 5, 3)]
    for history in (spans, spans[::-1]):
        got = valid_at(points, frame("k int, a int, b int, v int", *history), "k", "t", "a", "b", ["v"], split=None)
        assert rows(got, "t") == [(1, 4, 2), (1, 5, 2), (1, 9, None)]


def test_asof_ties_are_settled_by_columns(frame):
    left = frame("k int, t int", (1, 5))
    right = [(1, 3, 1, "a"), (1, 3, 2, "b")]
    for order in (right, right[::-1]):
        got = asof_join(left, frame("k int, t int, n int, v string", *order), "k", "t", "t", ["v"], right_ties=["n"], split=None)
        assert [r.v for r in got.collect()] == ["b"]
