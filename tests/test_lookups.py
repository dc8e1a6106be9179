"""Lookups in several tables, of shared instants, and running features continued from their state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan
from tidemark.functions import safe_divide
from tidemark.operators.asof import Features, asof_join, asof_join_collapsed, asof_join_many
from tidemark.operators.hot import Split
from tidemark.operators.running import (
    continue_running,
    last_state,
    run_count,
    run_first,
    run_last,
    run_max,
    run_min,
    run_previous,
    run_sum,
    running,
)
from tidemark.plans import specs, training
from tidemark.plans.jobs import attach_group_stats, attach_nested_stats
from tidemark.sources.tables import FeatureTable, KeyViolation, publish, publish_bucketed, read_sql

START = dt.datetime(2024, 1, 1)


def log(spark, seed, n=300, users=(1, 2, 3, None), step=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(users), START + dt.timedelta(hours=step * rng.randrange(200)), rng.choice([None, 1, 2, 5])) for k in range(n)]
    return spark.createDataFrame(rows, "id int, u int, t timestamp, v int").repartition(3)


def same(a, b):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.select(*a.columns).collect()), key=key)


def once(df):
    return df.groupBy(F.col("u").alias("k"), F.col("t").alias("at")).agg(F.max("v").alias("v"), F.max("id").alias("n"))


def test_several_tables_in_one_stack(spark):
    labels, tables = log(spark, 1), [once(log(spark, s)) for s in (2, 3, 4)]
    names = [{"v": f"v{i}", "n": f"n{i}"} for i in range(3)]
    want = labels
    for table, columns in zip(tables, names):
        want = asof_join(want, table, {"u": "k"}, "t", "at", columns, split=None)
    for split in (None, Split(20)):
        found = asof_join_many(labels, ["u"], "t", [Features(t, ("k",), "at", c) for t, c in zip(tables, names)], split=split)
        same(found, want)
    with pytest.raises(ValueError):
        asof_join_many(labels, ["u"], "t", [Features(tables[0], ("k",), "at", {"v": "x"})] * 2)


def test_one_shuffle_for_several_tables(spark):
    labels = log(spark, 1)
    table = spark.range(40).select((F.col("id") % 4).cast("int").alias("k"), F.lit(START).alias("at"), F.col("id").alias("v"))
    found = asof_join_many(labels, ["u"], "t", [Features(table, ("k",), "at", {"v": f"v{i}"}) for i in range(3)], split=None)
    assert plan(found).count("Exchange hashpartitioning") == 1


def test_bucketed_features_stay_where_they_lie(spark, tmp_path):
    table, labels = once(log(spark, 12)).where("k is not null"), log(spark, 13)
    laid = publish_bucketed(FeatureTable("f", table, ("k", "at"), "at"), "features_by_key", str(tmp_path / "f"), 8)
    assert laid.buckets == 8
    want = asof_join(labels, table, {"u": "k"}, "t", "at", {"v": "x"})
    for split in (None, Split(20), Split(1)):
        for strict in (False, True):
            found = asof_join(labels, laid.df, {"u": "k"}, "t", "at", {"v": "x"}, split=split, strict=strict, buckets=8)
            same(found, asof_join(labels, table, {"u": "k"}, "t", "at", {"v": "x"}, split=None, strict=strict))
    # the labels are moved, and nothing else
    text = plan(asof_join(labels, laid.df, {"u": "k"}, "t", "at", {"v": "x"}, split=None, buckets=8))
    assert text.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in text and "Bucketed: true" in text
    lookups = [training.Lookup(laid, "u", "t", ("v",), {"v": "x"}), training.Lookup(laid, "u", "t", ("n",))]
    built = training.build_training_set(labels, lookups[:1])
    same(built, want)
    both = training.build_training_set(labels, lookups)
    same(both, asof_join(want, table, {"u": "k"}, "t", "at", ["n"]))
    assert asof_join(labels.limit(0), laid.df, {"u": "k"}, "t", "at", ["n"], buckets=8).isEmpty()


def test_bucketed_by_two_keys_and_refusals(spark, tmp_path):
    cells = log(spark, 14, users=(1, 2, 3)).groupBy(F.col("u").alias("k"), (F.col("id") % 3).alias("g"), F.col("t").alias("at")).agg(F.max("v").alias("v"))
    table = FeatureTable("cells", cells, ("k", "g", "at"), "at")
    laid = publish_bucketed(table, "cells_by_key", str(tmp_path / "c"), 5)
    labels = log(spark, 15).withColumn("h", F.when(F.col("id") % 7 > 0, F.col("id") % 4))
    on = {"u": "k", "h": "g"}
    found = asof_join(labels, laid.df, on, "t", "at", {"v": "x"}, split=None, buckets=5)
    assert plan(found).count("Exchange hashpartitioning") == 1
    same(found, asof_join(labels, cells, on, "t", "at", {"v": "x"}, split=None))
    with pytest.raises(FileExistsError):
        publish_bucketed(table, "cells_by_key", str(tmp_path / "other"), 5)
    with pytest.raises(FileExistsError):
        publish_bucketed(table, "cells_again", str(tmp_path / "c"), 5)
    with pytest.raises(KeyViolation):
        publish_bucketed(FeatureTable("cells", cells.union(cells), ("k", "g", "at"), "at"), "cells_twice", str(tmp_path / "d"), 5)
    assert not spark.catalog.tableExists("cells_twice")
    with pytest.raises(ValueError):
        publish_bucketed(table, "cells_none", str(tmp_path / "e"), 0)
    with pytest.raises(ValueError):
        publish_bucketed(FeatureTable("no_entity", cells, ("at",), "at"), "cells_time", str(tmp_path / "g"), 2)


def test_shared_instants_are_looked_up_once(spark):
    labels = log(spark, 5, 200).withColumn("t", F.when(F.col("id") % 3 == 0, F.lit(START) + F.expr("interval 50 hours")).when(F.col("id") % 50 != 1, F.col("t")))
    table = once(log(spark, 6))
    same(asof_join_collapsed(labels, table, {"u": "k"}, "t", "at", {"v": "x"}), asof_join(labels, table, {"u": "k"}, "t", "at", {"v": "x"}))


@pytest.mark.parametrize("split", [None, Split(20)])
def test_running_features_continue_from_their_state(spark, split):
    df = log(spark, 7, 400)
    measures = {
        "s": run_sum("v"), "c": run_count("v"), "hi": run_max("v"), "lo": run_min("v"), "last": run_last("v"),
        "first": run_first("v"), "before": run_previous("v", F.lit(-1)),
    }
    whole = running(df, "u", "t", measures, ties=["id"], split=None)
    start = F.lit(START + dt.timedelta(hours=150))
    # what was published had other rows after the start, and one user had none before it
    published = whole.where("u is null or u < 3 or id % 2 = 0").where((F.col("u") != 3) | F.col("u").isNull() | (F.col("t") >= start))
    recent = df.where(F.col("t") >= start)
    state = last_state(published, "u", "t", [*measures, "v"], start, ties=["id"])
    found = continue_running(recent, state, "u", "t", measures, seeds={"before": "v"}, ties=["id"], split=split)
    fresh = running(recent, "u", "t", measures, ties=["id"], split=None)
    same(found, whole.where((F.col("t") >= start) & (F.col("u").isNull() | (F.col("u") != 3))).unionByName(fresh.where("u = 3")))


def test_nested_statistics_equal_two_groupings(spark):
    rng = random.Random(8)
    pick = lambda *x: rng.choice(x)
    rows = [(pick(1, 2, None), pick("a", "b", None), pick("x", None), pick(1, 2, 3, 4, None), pick(1.5, 2.5, None), pick(1, 7, None)) for _ in range(300)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "o int, i string, j string, job int, wage double, need int, row int")
    outer, inner = {"o": F.col("o")}, {"i": F.col("i"), "j": F.col("j")}
    stats = {"m": ("inner", "mean", "wage"), "n": ("inner", "units", None), "jobs": ("outer", "units", None), "need_sum": ("outer", "sum", "need"), "om": ("outer", "mean", "wage")}
    want = attach_group_stats(df, outer | inner, {"m": F.avg("wage"), "n": F.countDistinct("job")})
    want = attach_group_stats(want, outer, {"jobs": F.countDistinct("job"), "need_sum": F.sum("need"), "om": F.avg("wage")})
    rounded = [F.round("m", 9).alias("m"), F.round("om", 9).alias("om"), "n", "jobs", "need_sum", "row"]
    found = attach_nested_stats(df, outer, inner, "job", stats)
    same(found.select(*rounded), want.select(*rounded))
    assert found.count() == 300


def test_specs_are_created_once(spark, tmp_path):
    table = FeatureTable("spent", spark.createDataFrame([(1, START, 2.0)], "u int, t timestamp, v double"), ("u", "t"), "t")

    def spec(name="a", columns=("v",), **more):
        return specs.FeatureSpec(name, (training.Lookup(table, "u", "at", columns), training.Derived(safe_divide, "d", {"numerator": "v", "denominator": "w"})), **more)

    folder = str(tmp_path)
    first = specs.create_spec(spark, spec(), folder)
    assert specs.create_spec(spark, spec(), folder) == first == spec("b").content_hash()
    with pytest.raises(specs.SpecConflict):
        specs.create_spec(spark, spec(label="y"), folder)
    with pytest.raises(ValueError):
        specs.create_spec(spark, spec("../x"), folder)
    with pytest.raises(KeyError):
        specs.load_spec(spark, "none", folder, {})
    stored = specs.load_spec(spark, "a", folder, {"spent": table}, {"safe_divide": safe_divide})
    labels = spark.createDataFrame([(1, START + dt.timedelta(days=1), 4.0), (2, START, 1.0)], "u int, at timestamp, w double")
    assert [(r.v, r.d) for r in stored.training_set(labels).orderBy("u").collect()] == [(2.0, 0.5), (None, None)]
    other = FeatureTable("spent", table.df, ("u",))
    with pytest.raises(specs.SpecConflict):
        specs.load_spec(spark, "a", folder, {"spent": other}, {"safe_divide": safe_divide})


def test_sql_parameters_are_values(spark):
    df = spark.createDataFrame([(1, "it's"), (2, "x' OR '1'='1")], "id int, name string")
    ask = lambda **p: [r.id for r in read_sql(spark, "SELECT id FROM {t} WHERE name = :name -- not :this", p, t=df).collect()]
    assert ask(name="it's") == [1] and ask(name="x' OR '1'='1") == [2] and ask(name="' OR 1=1") == []
    for wrong in ({}, {"name": "a", "more": 1}):
        with pytest.raises(ValueError):
            ask(**wrong)


def test_publishing_observes_what_it_writes(spark, tmp_path):
    rows = [(k % 5, START + dt.timedelta(hours=k), k) for k in range(50)]
    df = spark.createDataFrame(rows, "u int, t timestamp, v int")
    seen = publish(FeatureTable("x", df, ("u", "t"), "t"), str(tmp_path / "x")).observed
    assert seen == {"rows": 50, "null_keys": 0, "first": START, "last": START + dt.timedelta(hours=49)}
    bad = df.withColumn("u", F.when(F.col("v") != 7, F.col("u")))
    with pytest.raises(KeyViolation, match="1 rows"):
        publish(FeatureTable("y", bad, ("u", "t"), "t"), str(tmp_path / "y"))
    assert not list(tmp_path.glob("y*"))
