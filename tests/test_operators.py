import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import shift_hours, start_slot
from tidemark.operators.dedupe import keep_first, most_frequent
from tidemark.operators.history import change_log_to_history, in_force_counts
from tidemark.operators.hot import Split
from tidemark.operators.rolling import rolling_distinct, rolling_means, rolling_totals
from tidemark.operators.shape import narrow_types, rename_all, sanitize_names
from tidemark.operators.vectors import running_vector, vector_total

from conftest import plan, rows, ts


def test_rolling_frames_hold_n_plus_one_rows(spark):
    days = spark.range(12).select(
        F.lit("u").alias("u"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"),
        F.col("id").alias("v"), F.when(F.col("id") % 4 != 3, F.col("id") % 3).alias("j"),
    )
    frames = {"t": ("v", None), "r": ("v", 2)}
    got = rows(rolling_totals(days, "u", "d", frames).select("t", "r", "d"), "d")
    values = list(range(12))
    assert [(t, r) for t, r, _ in got] == [(sum(values[: i + 1]), sum(values[max(0, i - 2) : i + 1])) for i in values]
    jobs = [None if i % 4 == 3 else i % 3 for i in values]
    got = rows(rolling_distinct(days, "u", "d", {"t": ("j", None), "r": ("j", 2)}).select("t", "r", "d"), "d")
    distinct = lambda xs: len({x for x in xs if x is not None})
    assert [(t, r) for t, r, _ in got] == [(distinct(jobs[: i + 1]), distinct(jobs[max(0, i - 2) : i + 1])) for i in values]
    means = rows(rolling_means(days, "u", "d", {"m": ("v", 2)}).select("m", "d"), "d")
    assert means[5][0] == 4.0


def test_rolling_measures_by_definition(spark):
    rng = random.Random(4)
    data = [
        (u, d, rng.choice([None, "a", "b", "c"]), rng.choice([None, 1.1, 0.1, 2.7]), rng.randrange(3))
        for u in (None, "x", "y") for d in range(rng.randrange(20, 40))
    ]
    df = spark.createDataFrame(data, "u string, d int, j string, v double, k int").repartition(3)
    sizes = (None, 0, 1, 4, 50)
    counted = rolling_distinct(df, "u", "d", {f"{c}{n}": (c, n) for c in ("j", "k") for n in sizes})
    found = rolling_means(counted, "u", "d", {f"v{n}": ("v", n) for n in sizes}).collect()
    assert len(found) == len(data)
    for r in found:
        for n in sizes:
            frame = [x for x in data if x[0] == r["u"] and x[1] <= r["d"] and (n is None or x[1] >= r["d"] - n)]
            assert r[f"j{n}"] == len({x[2] for x in frame} - {None}) and r[f"k{n}"] == len({x[4] for x in frame})
            values = [x[3] for x in frame if x[3] is not None]
            assert r[f"v{n}"] == pytest.approx(sum(values) / len(values), abs=1e-9) if values else r[f"v{n}"] is None


def test_rolling_distinct_builds_no_sets_and_shuffles_once(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("u"), F.col("id").alias("d"), (F.col("id") % 3).alias("j"))
    told = plan(rolling_distinct(df, "u", "d", {"a": ("j", 30), "b": ("j", 90), "c": ("j", None)}))
    assert "collect_set" not in told and told.count("Exchange") == 1


def test_last_running_total_is_the_group_sum(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("u"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"), (F.col("id") * 3).alias("v"))
    last = rolling_totals(df, "u", "d", {"t": ("v", None)}).groupBy("u").agg(F.max_by("t", "d").alias("t"))
    assert rows(last, "u") == rows(df.groupBy("u").agg(F.sum("v").alias("t")), "u")


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id"))
    best = keep_first(df, "k", [F.desc("id")])
    assert rows(best, "k") == [(0, 99), (1, 97), (2, 98)]
    assert "WindowGroupLimit" in plan(best)


def test_mode_breaks_ties_towards_the_smallest(frame):
    df = frame("k int, v int", (1, 5), (1, 3), (1, 5), (1, 3), (1, None), (2, None))
    assert rows(most_frequent(df, "k", "v")) == [(1, 3)]


def test_change_log_with_ties_and_no_op_edits(frame):
    current = frame("job int, new int", (1, 9), (2, 4))
    edits = frame(
        "job int, old int, new int, at timestamp_ntz, n int",
        (1, 5, 7, ts("2024-01-02"), 1), (1, 7, 9, ts("2024-01-02"), 2), (1, 9, 9, ts("2024-01-03"), 3),
    )
    got = change_log_to_history(current, edits, "job", "old", "new", "at", value="needed", prefer=["n"])
    assert rows(got, "job", "start_date") == [
        (1, 5, ts("2001-01-01")), (1, 9, ts("2024-01-02")), (2, 4, ts("2001-01-01")),
    ]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_in_force_counts_equal_pairing(spark, hot_rows):
    dice = random.Random(11)
    spans = []
    for _ in range(80):
        a = dice.randrange(100)
        spans.append((dice.choice("aab"), a, a + 1 + dice.randrange(30)))
    at = lambda h: ts("2024-01-01T00:00:00").replace(day=1 + h // 24, hour=h % 24)
    steps = [(k, at(x), s) for k, a, b in spans for x, s in ((a, 1), (b, -1))]
    df = spark.createDataFrame(steps, "k string, t timestamp_ntz, s int")
    got = in_force_counts(df, ["k"], "t", {"n": "s"}, split=Split(hot_rows, "day"))
    for k, t, n in rows(got):
        assert n == sum(1 for kk, a, b in spans if kk == k and at(a) <= t < at(b))


def _shifts(spark, n=400):
    dice = random.Random(2)
    used, data = set(), []
    while len(data) < n:
        u = "hot" if len(data) % 3 == 0 else f"u{dice.randrange(20)}"
        at = ts("2024-01-01T00:00:00").replace(day=1 + dice.randrange(20), hour=dice.randrange(24), minute=dice.randrange(60))
        if (u, at) not in used:
            used.add((u, at))
            data.append((u, at, dice.randrange(24)))
    return spark.createDataFrame(data, "u string, t timestamp_ntz, e int"), data


@pytest.mark.parametrize("hot_rows", [50, 10**6])
def test_running_vector_against_brute_force(spark, hot_rows):
    df, data = _shifts(spark)
    first, hours = start_slot(F.hour("t"), F.dayofweek("t")), shift_hours(F.hour("t"), F.col("e"))
    got = {(r.u, r.t): r.v for r in running_vector(df, "u", "t", first, hours, "v", split=Split(hot_rows, "day")).collect()}
    totals = {}
    for u, t, e in sorted(data):
        vector = totals.setdefault(u, [0] * 168)
        span = e - t.hour if e > t.hour else e - t.hour + 24
        for h in range(span):
            vector[((t.isoweekday() % 7) * 24 + t.hour + h) % 168] += 1
        assert got[(u, t)] == vector
    assert len(got) == len(data)
    sums = {r.u: r.v for r in vector_total(df, "u", first, hours, "v").collect()}
    assert sums == totals


def test_vectors_across_arrow_batches(spark):
    """Groups that span batches keep their state; batches that span groups reset it."""
    df, _ = _shifts(spark)
    first, hours = start_slot(F.hour("t"), F.dayofweek("t")), shift_hours(F.hour("t"), F.col("e"))
    whole = rows(running_vector(df, "u", "t", first, hours, "v"), "u", "t")
    total = rows(vector_total(df, "u", first, hours, "v"), "u")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows(running_vector(df, "u", "t", first, hours, "v"), "u", "t") == whole
        assert rows(vector_total(df, "u", first, hours, "v"), "u") == total
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_narrowing_leaves_keys_alone(frame):
    df = frame("id bigint, n bigint, d decimal(10,2), s string", (16_777_217, 16_777_217, None, "x"))
    got = narrow_types(df, keep=["ID"])
    assert [t for _, t in got.dtypes] == ["bigint", "float", "float", "string"]
    assert rows(got) == [(16_777_217, 16_777_216.0, None, "x")]


def test_names_that_collide_are_refused(frame):
    df = frame("a int, A2 int", (1, 2))
    assert rename_all(df, str.upper).columns == ["A", "A2"]
    with pytest.raises(ValueError):
        rename_all(df, lambda c: "x")
    odd = df.toDF("Food (CA), 1", "Food(CA)1")
    with pytest.raises(ValueError):
        sanitize_names(odd)
    assert sanitize_names(df.toDF("a=b {c}", "d|e%+f;")).columns == ["abc", "def"]
