"""A stream whose processes are killed goes on from its checkpoint with nothing lost or doubled."""

import os
import signal
import subprocess
import sys
import time
from pathlib import Path

from helpers import trade, write_batches

from tapeline.operators.served import as_totals, latest_rows
from tapeline.operators.totals import window_totals
from tapeline.sources.files import read_trades
from tapeline.streaming.runs import start
from tapeline.streaming.sinks import append_to_log, read_log, with_row_ids

SCRIPT = """
import sys
sys.path[:0] = [{repo!r}, {repo!r} + "/tests"]
from pyspark.sql import SparkSession
from test_killed import totals_query
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
totals_query(spark, {base!r}, interval="0 seconds").awaitTermination()
"""


def totals_query(spark, base, **run):
    trades = read_trades(spark, f"{base}/in", maxFilesPerTrigger=1)
    writer = (
        with_row_ids(window_totals(trades))
        .writeStream.outputMode("update")
        .foreachBatch(append_to_log(f"{base}/log"))
    )
    return start(spark, writer, f"{base}/state", **run)


def rows_of(totals):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in row)
        for row in totals.collect()
    )


def test_killed_and_started_again(spark, tmp_path):
    base, repo = str(tmp_path), str(Path(__file__).resolve().parent.parent)
    rows = [
        trade(TS=1_610_100_000 + n // 4, P=float(n % 13), F="12"[n % 2], ID=str(n))
        for n in range(3_000)
    ]
    write_batches(tmp_path / "in", [rows[n : n + 100] for n in range(0, 3_000, 100)])
    process = subprocess.Popen(
        [sys.executable, "-c", SCRIPT.format(base=base, repo=repo)], stderr=subprocess.DEVNULL
    )
    offsets = tmp_path / "state" / "offsets"
    for _ in range(600):
        if offsets.exists() and any(int(f.name) >= 2 for f in offsets.glob("[0-9]*")):
            break
        time.sleep(0.1)
    listed = subprocess.run(
        ["ps", "-o", "pid=", "--ppid", str(process.pid)], capture_output=True, text=True, check=True
    )
    for pid in [*map(int, listed.stdout.split()), process.pid]:
        os.kill(pid, signal.SIGKILL)
    process.wait()
    assert len(list(offsets.glob("[0-9]*"))) < 30

    totals_query(spark, base, once=True).awaitTermination()
    log = read_log(spark, f"{base}/log")
    expected = window_totals(read_trades(spark, f"{base}/in", stream=False))
    assert rows_of(as_totals(latest_rows(log))) == rows_of(expected)
    assert log.select("batch_ms", "batch_id").distinct().count() == 30
    assert log.select("uuid").distinct().count() == log.count()
