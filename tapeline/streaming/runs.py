"""Run control: settings, triggers, bounded runs, folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

TRIGGER = "15 seconds"
RUN_SECONDS = 60

# State on local disk instead of the heap, saved as change logs: open groups may be many.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for the queries started inside; a query keeps the settings it started with."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start(
    spark: SparkSession,
    writer: DataStreamWriter,
    checkpoint: str,
    *,
    interval: str = TRIGGER,
    once: bool = False,
    shuffle_partitions: int | None = None,
    state_settings: Mapping[str, str] = STATE_SETTINGS,
) -> StreamingQuery:
    """Start a query: a micro-batch every `interval`, or with `once` all there is and no more.

    `shuffle_partitions` is also the number of state partitions. It counts when the checkpoint
    is new and is fixed from then on, so choose it for the largest cluster the query will see.
    """
    settings = dict(state_settings)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    with session_settings(spark, settings):
        return writer.start()


def run_for(query: StreamingQuery, seconds: float = RUN_SECONDS) -> bool:
    """Wait at most `seconds` for the query, then stop it. True if it ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and logs, in the folder the cluster shares.

    That is `spark.checkpoint.dir`, else a folder in the warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{shared.rstrip('/')}/tapeline/{name}-{uuid.uuid4().hex}"
