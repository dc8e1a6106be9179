"""Arrow functions run where the workers know nothing of this package."""

import os
import pathlib
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from __spark_entry__ import queries
for key in ("a_vector_sum", "p_training_similarity"):
    print(key, queries()[key](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_run_from_another_folder_without_pythonpath(tmp_path):
    root = str(pathlib.Path(__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-2000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("a_", "p_")))
    assert set(counts) == {"a_vector_sum", "p_training_similarity"} and all(int(n) > 0 for n in counts.values())
