"""Queries run from a folder from which executors cannot import this package."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").getOrCreate()
)
for name in ("trade_window_agg_stateful", "trade_window_agg_stream"):
    print("rows", contract.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_do_not_need_the_package(tmp_path):
    repo = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)],
        cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False,
        env={key: value for key, value in os.environ.items() if key != "PYTHONPATH"},
    )
    counts = [line for line in done.stdout.splitlines() if line.startswith("rows")]
    assert len(counts) == 2 and len(set(counts)) == 1, done.stderr[-2000:]
