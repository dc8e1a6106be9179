import pytest
from pyspark.sql import functions as F

from tidemark.sources.catalog import Tables
from tidemark.sources.staging import stage, work_dir
from tidemark.sources.tables import (
    FeatureTable,
    KeyViolation,
    look_back,
    publish,
    read_query,
    upsert,
    write_table,
)

from conftest import plan, rows, ts


def test_publish_checks_keys_before_writing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for bad in ([(1, 1), (1, 2)], [(None, 1)]):
        with pytest.raises(KeyViolation):
            publish(FeatureTable("t", frame("k int, v int", *bad), ("k",)), path)
        assert not (tmp_path / "t").exists()
    done = publish(FeatureTable("t", frame("k int, v int", (1, 1), (2, 2)), ("k",)), path)
    assert rows(done.df, "k") == [(1, 1), (2, 2)] and done.features == ["v"]
    with pytest.raises(Exception, match="(?i)exist"):
        publish(FeatureTable("t", frame("k int, v int", (3, 3)), ("k",)), path)
    assert rows(publish(FeatureTable("t", frame("k int, v int", (3, 3)), ("k",)), path, "overwrite").df) == [(3, 3)]


def test_feature_table_needs_its_keys(frame):
    df = frame("k int, t timestamp_ntz", (1, ts("2024-01-01")))
    with pytest.raises(ValueError):
        FeatureTable("t", df, ("x",))
    with pytest.raises(ValueError):
        FeatureTable("t", df, ("k",), "t")


def test_write_modes(spark, frame, tmp_path):
    path = str(tmp_path / "m")
    write_table(frame("k int", (1,)), path)
    write_table(frame("k int", (2,)), path, "append")
    write_table(frame("k int", (3,)), path, "ignore")
    assert rows(spark.read.parquet(path), "k") == [(1,), (2,)]
    with pytest.raises(ValueError):
        write_table(frame("k int", (1,)), path, "merge")


@pytest.mark.parametrize("partitioned", [False, True])
def test_upsert_replaces_adds_and_keeps(spark, frame, tmp_path, partitioned):
    path = str(tmp_path / "u")
    schema = "k int, d date, v string"
    day = lambda n: ts(f"2024-01-0{n}").date()
    old = frame(schema, (1, day(1), "a"), (2, day(1), "b"), (1, day(2), "c"))
    write_table(old, path, partition_by=["d"] if partitioned else [])
    new = frame(schema, (2, day(1), "B"), (9, day(3), "n"))
    got = upsert(spark, path, new, ["k", "d"], partition_by="d" if partitioned else None)
    assert rows(got.select("k", "d", "v"), "d", "k") == [(1, day(1), "a"), (2, day(1), "B"), (1, day(2), "c"), (9, day(3), "n")]
    with pytest.raises(KeyViolation):
        upsert(spark, path, frame(schema, (2, day(1), "x"), (2, day(1), "y")), ["k", "d"])


def test_partitioned_upsert_leaves_other_partitions_untouched(spark, frame, tmp_path):
    path = tmp_path / "p"
    write_table(frame("k int, d int, v int", (1, 1, 1), (2, 2, 2)), str(path), partition_by=["d"])
    before = sorted(f.name for f in (path / "d=2").iterdir())
    upsert(spark, str(path), frame("k int, d int, v int", (1, 1, 5)), ["k", "d"], partition_by="d")
    assert sorted(f.name for f in (path / "d=2").iterdir()) == before


def test_look_back_reaches_the_scan(spark, frame, tmp_path):
    frame("k int, t timestamp_ntz", (1, ts("2024-01-01")), (2, ts("2024-01-30")), (3, ts("2024-01-31"))).write.parquet(str(tmp_path / "l"))
    got = look_back(spark.read.parquet(str(tmp_path / "l")), "t", "2024-01-31", 20)
    assert rows(got.select("k")) == [(2,)]
    assert "GreaterThanOrEqual(t,2024-01-11" in plan(got)


def test_staging_uses_the_shared_folder_and_cuts_lineage(spark, frame):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark) == shared
    staged = stage(frame("k int", (1,), (2,)).withColumn("n", F.col("k") * 2))
    assert f"{shared}/staged-" in staged.inputFiles()[0]
    assert rows(staged, "k") == [(1, 2), (2, 4)]


def test_read_query_by_format(spark, frame, tmp_path):
    frame("k int", (5,)).write.json(str(tmp_path / "j"))
    assert rows(read_query(spark, "json", {"path": str(tmp_path / "j")})) == [(5,)]


def test_tables_by_folder_and_by_catalog_name(spark, frame, tmp_path):
    tables = Tables(spark, {"a": str(tmp_path / "a"), "b": "default.tidemark_b"})
    for name in ("a", "b"):
        tables.write(frame("k int", (1,)), name, "overwrite")
        tables.write(frame("k int", (2,)), name, "append")
        assert rows(tables.read(name), "k") == [(1,), (2,)]
    spark.sql("DROP TABLE default.tidemark_b")
    with pytest.raises(KeyError, match="no location"):
        tables.read("c")
    with pytest.raises(ValueError):
        tables.write(frame("k int", (1,)), "b", "merge")


def test_upsert_reads_the_null_partition(spark, frame, tmp_path):
    path = str(tmp_path / "n")
    schema = "k string, p string"
    write_table(frame(schema, ("a", None), ("b", "x")), path, partition_by=["p"])
    got = upsert(spark, path, frame(schema, ("c", None)), ["k"], partition_by="p")
    assert rows(got, "k") == [("a", None), ("b", "x"), ("c", None)]


def test_upsert_moves_keys_between_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "v")
    schema = "k string, p string"
    write_table(frame(schema, ("a", "x"), ("b", "z")), path, partition_by=["p"])
    got = upsert(spark, path, frame(schema, ("a", "y")), ["k"], partition_by="p")
    assert rows(got, "k") == [("a", "y"), ("b", "z")]
    assert [f.name for f in tmp_path.iterdir()] == ["v"]


def test_publish_append_checks_the_table_too(spark, frame, tmp_path):
    path = str(tmp_path / "a")
    one, two = (FeatureTable("t", frame("k int, v int", (n, n)), ("k",)) for n in (1, 2))
    publish(one, path)
    with pytest.raises(KeyViolation):
        publish(one, path, "append")
    assert rows(publish(two, path, "append").df, "k") == [(1, 1), (2, 2)]
    assert rows(publish(one, path, "ignore").df, "k") == [(1, 1), (2, 2)]
    assert [f.name for f in tmp_path.iterdir()] == ["a"]


def test_publish_through_a_named_staging_table(spark, frame, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "t_staging")
    table = lambda *data: FeatureTable("t", frame("k int, v int", *data), ("k",))
    with pytest.raises(KeyViolation):
        publish(table((1, 1), (1, 2)), path, staging=staging)
    # no table, but its rows can be looked up
    assert not (tmp_path / "t").exists() and rows(spark.read.parquet(staging), "v") == [(1, 1), (1, 2)]
    done = publish(table((1, 1), (2, 2)), path, staging=staging)
    assert rows(done.df, "k") == rows(spark.read.parquet(staging), "k") == [(1, 1), (2, 2)]
    assert done.observed["rows"] == 2
    publish(table((3, 3)), path, "append", staging=staging)
    assert rows(spark.read.parquet(path), "k") == [(1, 1), (2, 2), (3, 3)] and rows(spark.read.parquet(staging)) == [(3, 3)]
    with pytest.raises(ValueError):
        publish(table((4, 4)), path, "overwrite", staging=path + "/")
