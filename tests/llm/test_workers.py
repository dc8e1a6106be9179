"""Text operators run where the workers know nothing of this package."""

import os
import pathlib
import subprocess
import sys

KEYS = ["op1_quality", "op4_packing", "op5_ngram_jaccard", "op6_suffix_dedup", "op7_exact_dedup", "op9_sharding", "op10_language_model", "op11_periodic_runs"]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
from __spark_entry__ import queries
for key in {keys!r}:
    print(key, queries()[key](spark, "/root/testdata/sf0.001").count())
"""


def run(tmp_path, keys):
    root = str(pathlib.Path(__file__).resolve().parent.parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root, keys=keys)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))


def test_text_queries_run_from_another_folder(tmp_path):
    counts = run(tmp_path, KEYS)
    assert set(counts) == set(KEYS) and all(int(n) > 0 for n in counts.values())


def test_every_operator_hands_the_package_out():
    from tidemark.llm import exact, jaccard, language, packing, periodic, quality, repeats, sharding

    for operator in (
        exact.exact_groups, jaccard.jaccard_groups, language.train, language.score_texts, packing.pieces, packing.pack,
        periodic.periodic_runs, quality.train, repeats.remove_repeats, sharding.shard_rows,
    ):
        assert hasattr(operator, "__wrapped__"), operator
