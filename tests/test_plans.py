"""What the plans must look like at scale."""

import re
from datetime import datetime

import pytest
from helpers import trade, trades_frame
from pyspark.sql import functions as F

from tapeline.operators.frames import classify_frames, count_kinds, trades_of
from tapeline.operators.records import decode_records, decoded_trades, encode_records
from tapeline.operators.served import latest_rows, rows_of_date
from tapeline.operators.subscriptions import subscribed_trades
from tapeline.operators.totals import window_totals
from tapeline.plans.jobs import feed_records, topic_trades
from tapeline.schemas import CHANGE_LOG, SERVED, TRADE
from tapeline.sources.files import read_lines, read_trades
from tapeline.streaming.runs import session_settings
from tapeline.streaming.sinks import read_log


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def trade_files(spark, tmp_path):
    trades_frame(spark, [trade(), trade(F="4"), trade(F="1")]).write.parquet(str(tmp_path / "t"))
    return read_trades(spark, str(tmp_path / "t"), file_format="parquet", stream=False)


def test_totals_shuffle_once_after_a_partial_aggregation(trade_files):
    text = plan(window_totals(trade_files))
    tree = text.split("(1)")[0]
    assert len(re.findall(r"[-+] Exchange \(", tree)) == 1
    assert tree.count("HashAggregate") == 2
    assert "partial_sum" in text
    assert "Python" not in text


def test_totals_read_what_they_need(trade_files):
    text = plan(window_totals(trade_files))
    assert "In(F, [1,2])" in text
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    names = {column.split(":")[0] for column in schema.split(",")}
    # A stored trade counts if all its fields are there, so all are read.
    assert names == set(TRADE.fieldNames())
    assert "IsNotNull(TSYM)" in text


def test_totals_of_any_rows_read_what_they_need(spark, tmp_path):
    trades_frame(spark, [trade()]).write.parquet(str(tmp_path / "t"))
    text = plan(window_totals(spark.read.schema(TRADE).parquet(str(tmp_path / "t"))))
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    names = {column.split(":")[0] for column in schema.split(",")}
    assert names == {"M", "FSYM", "F", "TS", "Q", "P", "TOTAL"}


@pytest.mark.parametrize(
    "make",
    [
        lambda lines: window_totals(trades_of(classify_frames(lines))),
        lambda lines: count_kinds(classify_frames(lines)),
        lambda lines: window_totals(decoded_trades(decode_records(lines))),
        lambda lines: encode_records(trades_of(classify_frames(lines))),
        feed_records,
        lambda lines: window_totals(topic_trades(lines)),
    ],
)
def test_text_is_parsed_once(spark, tmp_path, make):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text("{}\n")
    text = plan(make(read_lines(spark, str(tmp_path / "in"), stream=False)))
    assert text.count("from_json(") == 1


def test_small_channel_tables_are_broadcast_by_the_threshold(spark, trade_files, tmp_path):
    names = ["0~Coinbase~BTC~USD", "0~Kraken~BTC~USD"]
    path = str(tmp_path / "channels")
    spark.createDataFrame([(name,) for name in names], "channel string").write.parquet(path)
    table = spark.read.parquet(path)
    for channels in (names, table):
        assert "BroadcastHashJoin" in plan(subscribed_trades(trade_files, channels))
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for channels in (names, table):
            kept = subscribed_trades(trade_files, channels)
            assert "Broadcast" not in plan(kept)
            assert kept.columns == trade_files.columns
            assert sorted(kept.collect()) == sorted(trade_files.collect())
            assert subscribed_trades(trade_files, ["0~A~B~C", "0~A~B~D"]).count() == 0


def test_no_job_runs_while_the_join_is_planned(spark, trade_files):
    table = spark.createDataFrame([("0~Coinbase~BTC~USD",)], "channel string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planned", "planned")
    subscribed_trades(trade_files, table)
    assert list(tracker.getJobIdsForGroup("planned")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_hot_market_is_split_when_channels_are_shuffled(spark, tmp_path):
    """All trades are of one market; the join still has more than one busy task."""
    path = str(tmp_path / "hot")
    rows = trades_frame(spark, [trade()]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(60_000))))
    rows.withColumn("ID", F.col("n").cast("string")).drop("n").repartition(16).write.parquet(path)
    split = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    with session_settings(spark, split):
        trades = read_trades(spark, path, file_format="parquet", stream=False)
        kept = subscribed_trades(trades, ["0~Coinbase~BTC~USD"])
        parts = kept.select("ID", F.spark_partition_id().alias("part")).collect()
    assert len(parts) == 60_000
    assert len({row["part"] for row in parts}) > 2


def test_one_date_reads_one_folder(spark, tmp_path):
    day = datetime(2021, 1, 8)
    row = (day, day, "M", "BUY", "BTC", "USD", 1.0, 1.0, 1.0, 1, "u", 1, 0, day.date())
    spark.createDataFrame([row], SERVED).write.partitionBy("date").parquet(str(tmp_path / "table"))
    table = spark.read.schema(SERVED).parquet(str(tmp_path / "table"))
    text = plan(rows_of_date(table, "2021-01-08"))
    assert re.search(r"PartitionFilters: .*date#\d+ = 2021-01-08", text)


def test_one_open_date_is_filtered_in_the_log_scan(spark, tmp_path):
    spark.createDataFrame([], CHANGE_LOG).write.parquet(str(tmp_path / "log"))
    text = plan(rows_of_date(latest_rows(read_log(spark, str(tmp_path / "log"))), "2021-01-08"))
    assert "EqualTo(date,2021-01-08)" in text


def test_latest_rows_combine_before_the_shuffle(spark):
    tree = plan(latest_rows(spark.createDataFrame([], CHANGE_LOG))).split("(1)")[0]
    assert len(re.findall(r"[-+] Exchange \(", tree)) == 1
    assert tree.count("HashAggregate (") == tree.count("Aggregate (") == 2
    assert "Sort" not in tree
