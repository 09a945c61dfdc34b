"""The served table: latest rows by key, manifests, folds beside readers, clustered files."""

import datetime
import glob
import threading
import uuid

import pyarrow.parquet as pq
import pytest
from helpers import trade, trades_frame
from pyspark.sql import functions as F

from tapeline.operators.served import as_totals, latest_rows, rows_of_date, rows_of_windows
from tapeline.operators.totals import window_totals
from tapeline.schemas import CHANGE_LOG, SERVED
from tapeline.streaming import manifests
from tapeline.streaming.runs import session_settings
from tapeline.streaming.sinks import append_to_log, fold_log, keep_table, read_served, read_table

WINDOW = datetime.datetime(2021, 1, 8, 10)


def log_row(batch_ms, batch_id, n, *, coin="BTC", label="USD", row_id=None, market="M"):
    return (
        WINDOW, WINDOW, market, "BUY", coin, label, float(n), None if n == 0 else 2.0 * n, 1.0, n,
        row_id, WINDOW.date(), batch_ms, batch_id,
    )


def append(spark, log, batch_id, rows, batch_ms=None):
    totals = window_totals(trades_frame(spark, rows)).withColumn("uuid", F.lit(str(uuid.uuid1())))
    at = 1_000 + batch_id if batch_ms is None else batch_ms
    append_to_log(log)(totals.withColumn("batch_ms", F.lit(at).cast("bigint")), batch_id)


def counts(table):
    return {(r.market, str(r.date)): r.counttxns for r in table.collect()}


def test_latest_rows_carry_ids_labels_and_nulls(spark):
    ids = [str(uuid.uuid1()), "ffffffff-ffff-1fff-ffff-ffffffffffff", "00000000-0000-1000-8000-000000000000"]
    log = [
        log_row(5, 9, 1, row_id=ids[0]), log_row(6, 0, 0, row_id=ids[1], label="Złoty €"),
        log_row(6, 1, 3, coin="ETH", row_id=ids[2], label="x" * 16), log_row(6, 0, 4, coin="ETH"),
        log_row(1, 1, 5, coin="X", label=None, row_id="no id"),
    ]
    rows = latest_rows(spark.createDataFrame(log, CHANGE_LOG)).collect()
    got = {r.fromcoin: (r.batch_ms, r.batch_id, r.counttxns, r.avgprice, r.tocurrency, r.uuid) for r in rows}
    assert got == {
        "BTC": (6, 0, 0, None, "Złoty €", ids[1]),
        "ETH": (6, 1, 3, 6.0, "x" * 16, ids[2]),
        "X": (1, 1, 5, 10.0, None, None),
    }


def test_a_label_that_is_too_long_is_an_error(spark):
    log = spark.createDataFrame([log_row(1, 1, 1, label="x" * 17)], CHANGE_LOG)
    with pytest.raises(Exception, match="16 bytes at most"):
        latest_rows(log).collect()


def test_a_reader_that_began_before_a_fold_ends_after_it(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    append(spark, log, 0, [trade(), trade(M="Kraken")])
    fold_log(spark, log, table)
    readers = [read_table(spark, table), read_served(spark, log, table)]
    append(spark, log, 1, [trade()] * 3)
    fold_log(spark, log, table)
    day = "2021-01-08"
    for reader in readers:
        assert counts(reader) == {("Coinbase", day): 1, ("Kraken", day): 1}
    after = {("Coinbase", day): 3, ("Kraken", day): 1}
    assert counts(read_table(spark, table)) == counts(read_served(spark, log, table)) == after
    # Without retention the folder is gone from under the reader, so the test above can fail.
    append(spark, log, 2, [trade()] * 4)
    reader = read_table(spark, table)
    fold_log(spark, log, table, retain_seconds=0)
    with pytest.raises(Exception, match="(?i)not exist|not found|no such file"):
        reader.collect()


def test_only_changed_dates_get_a_new_folder(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    append(spark, log, 0, [trade(day=f"2021-01-{d:02d}") for d in range(1, 9)])
    fold_log(spark, log, table)
    first = manifests.latest(spark, table)
    later = str(tmp_path / "later")
    append(spark, later, 1, [trade(day="2021-01-03", price=7.0)])
    fold_log(spark, later, table)
    second = manifests.latest(spark, table)
    assert (first.version, second.version, second.upto) == (0, 1, 1_001)
    assert {d for d in first.live if first.live[d] != second.live[d]} == {"2021-01-03"}
    assert len(second.live) == 8
    assert read_table(spark, table).count() == 8
    assert read_table(spark, table, "2021-01-03").first().avgprice == 7.0
    assert read_table(spark, table, "2030-01-01").count() == 0


def test_a_fold_that_loses_the_race_starts_again(spark, tmp_path, monkeypatch):
    log, other, table = (str(tmp_path / x) for x in ("log", "other", "table"))
    append(spark, log, 0, [trade()])
    append(spark, other, 1, [trade(M="Kraken")])
    commit, raced = manifests.commit, []

    def late_commit(spark, table, manifest):
        if not raced:
            raced.append(True)
            fold_log(spark, other, table)
        return commit(spark, table, manifest)

    monkeypatch.setattr(manifests, "commit", late_commit)
    fold_log(spark, log, table)
    assert counts(read_table(spark, table)) == {("Coinbase", "2021-01-08"): 1, ("Kraken", "2021-01-08"): 1}
    assert manifests.versions(spark, table) == [0, 1]
    assert len(list((tmp_path / "table").glob("generation=*"))) == 2


def test_two_commits_of_one_number(spark, tmp_path):
    table = str(tmp_path / "table")
    drafts = [manifests.Manifest().after({"2021-01-08": f"g{n}/date=2021-01-08"}, n) for n in range(4)]
    taken = []
    threads = [threading.Thread(target=lambda m=m: taken.append(manifests.commit(spark, table, m))) for m in drafts]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(taken) == [False, False, False, True]
    assert manifests.latest(spark, table).live in [m.live for m in drafts]
    assert [p.name for p in (tmp_path / "table" / "_manifests").glob("[!.]*")] == [f"{0:020d}.json"]


def test_a_fold_that_stops_before_its_commit(spark, tmp_path, monkeypatch):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    append(spark, log, 0, [trade()])
    fold_log(spark, log, table)
    append(spark, log, 1, [trade()] * 2)

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(manifests, "commit", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        fold_log(spark, log, table)
    monkeypatch.undo()
    assert counts(read_table(spark, table)) == {("Coinbase", "2021-01-08"): 1}
    assert counts(read_served(spark, log, table)) == {("Coinbase", "2021-01-08"): 2}
    fold_log(spark, log, table, retain_seconds=0)
    assert counts(read_table(spark, table)) == {("Coinbase", "2021-01-08"): 2}
    # The folder of the stopped fold is left for a day, as it could be one that is being written.
    assert len(list((tmp_path / "table").glob("generation=*"))) == 2
    monkeypatch.setattr(manifests, "ORPHAN_SECONDS", -1)
    manifests.expire(spark, table, 0)
    assert len(list((tmp_path / "table").glob("generation=*"))) == 1
    assert counts(read_table(spark, table)) == {("Coinbase", "2021-01-08"): 2}


def test_a_table_from_before_there_were_manifests(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    old = [log_row(1, 0, 1), log_row(1, 0, 2, market="Old")]
    old.append((*log_row(1, 0, 3)[:-3], datetime.date(2021, 1, 9), 1, 0))
    rows = spark.createDataFrame(old, CHANGE_LOG).select(*SERVED.fieldNames())
    rows.write.partitionBy("date").parquet(f"{table}/generation=1-x")
    assert read_table(spark, table).count() == 3
    append(spark, log, 1, [trade()])
    assert read_served(spark, log, table).count() == 4
    fold_log(spark, log, table)
    assert read_table(spark, table).count() == 4
    assert len(manifests.latest(spark, table).live) == 2


def test_batches_leave_the_log_after_the_time_to_retain(spark, tmp_path):
    for retain, left in ((3600, 4), (0, 0)):
        log, table = str(tmp_path / f"log{retain}"), str(tmp_path / f"table{retain}")
        write = keep_table(log, table, every=2, retain_seconds=retain)
        for batch_id in range(4):
            totals = window_totals(trades_frame(spark, [trade()] * (batch_id + 1)))
            rows = totals.withColumn("uuid", F.lit(None).cast("string"))
            write(rows.withColumn("batch_ms", F.lit(10 + batch_id).cast("bigint")), batch_id)
        assert len(glob.glob(f"{log}/batch_ms=*")) == left
        assert counts(read_served(spark, log, table)) == {("Coinbase", "2021-01-08"): 4}
        assert counts(read_table(spark, table)) == {("Coinbase", "2021-01-08"): 4}


def many_windows(spark, log):
    """A date of 1,440 windows in several markets."""
    minutes = spark.range(1440 * 40).select(
        (F.col("id") % 1440).alias("minute"), F.concat(F.lit("m"), (F.col("id") / 1440).cast("int")).alias("M")
    )
    day = 1_610_064_000
    trades = minutes.selectExpr(
        "'0' TYPE", "M", "'BTC' FSYM", "'USD' TSYM", "'1' F", "'1' ID", f"{day} + 60 * minute TS",
        "1D Q", "1D P", "1D TOTAL", "0L RTS",
    )
    rows = window_totals(trades).withColumn("uuid", F.lit(None).cast("string"))
    append_to_log(log)(rows.withColumn("batch_ms", F.lit(1).cast("bigint")), 0)


def test_windows_of_a_date_are_clustered_and_skipped(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    many_windows(spark, log)
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "65536")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size.row.check.min", "100")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.size.row.check.min", "100")
    try:
        fold_log(spark, log, table)
    finally:
        for name in ("parquet.block.size", "parquet.block.size.row.check.min", "parquet.page.size.row.check.min"):
            spark.sparkContext._jsc.hadoopConfiguration().unset(name)
    groups = []
    for file in glob.glob(f"{table}/generation=*/date=2021-01-08/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("window_end")
        for n in range(meta.num_row_groups):
            ends = meta.row_group(n).column(column).statistics
            groups.append((ends.min, ends.max, meta.row_group(n).num_rows))
    # Groups are ranges that follow each other.
    groups.sort()
    assert len(groups) >= 4
    assert all(a[1] <= b[0] for a, b in zip(groups, groups[1:], strict=False))
    served = read_table(spark, table, "2021-01-08")
    wanted = rows_of_windows(served, "2021-01-08 10:00:00", "2021-01-08 10:05:00")
    rows = wanted.collect()
    assert len(rows) == 5 * 40
    assert [r.window_end for r in rows] == sorted((r.window_end for r in rows), reverse=True)
    plan = wanted._jdf.queryExecution().executedPlan()
    assert "LessThanOrEqual(window_end" in plan.toString()
    with session_settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        scanned = rows_of_windows(served, "2021-01-08 10:00:00", "2021-01-08 10:05:00")
        scanned.collect()
        leaves = scanned._jdf.queryExecution().executedPlan().collectLeaves()
        read = leaves.apply(0).metrics().apply("numOutputRows").value()
    # Row groups out of the range are never decoded.
    assert 0 < read < 1440 * 40 / 2


def test_rows_of_windows_across_midnight(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    clocks = ("23:57:30", "23:58:30", "23:59:30")
    append(spark, log, 0, [trade(c) for c in clocks] + [trade("00:00:30", day="2021-01-09")])
    fold_log(spark, log, table)
    rows = rows_of_windows(read_table(spark, table), "2021-01-08 23:58:00", "2021-01-09 00:00:00").collect()
    assert [f"{r.window_end:%d %H:%M}" for r in rows] == ["09 00:00", "08 23:59"]
    assert as_totals(rows_of_date(read_table(spark, table), "2021-01-09")).count() == 2
