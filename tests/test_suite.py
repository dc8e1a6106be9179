"""Registered queries against their SQL. ``tools/verify.py`` covers every key at any scale."""

import os

import duckdb
import pytest

import suite
from __spark_entry__ import FLAGSHIP, oracle_sql, queries
from suite.base import TABLES
from tools.verify import canonical

FOLDER = "/root/testdata/sf0.001"
SAMPLE = "p_training_similarity p_work_history p_applicants j_asof j_interval_half_open w_running_vector a_radius_counts s_upsert l_derived x_haversine".split()
KEYS = sorted(suite.QUERIES) if os.environ.get("SUITE") == "all" else SAMPLE

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@needs_data
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, duck, key):
    mine = queries()[key](spark, FOLDER).toPandas()
    theirs = duck.execute(oracle_sql()[key]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert canonical(mine) == canonical(theirs)
    assert len(mine)


def test_every_query_has_sql_and_the_flagship_is_one():
    assert set(suite.SQL) == set(suite.QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
    assert FLAGSHIP in queries()
