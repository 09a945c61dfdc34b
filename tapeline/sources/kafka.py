"""Trades from a topic. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str, topic: str, starting_offsets: str = "latest", **options: str | int
) -> dict[str, str]:
    """Source options for one topic.

    The offsets apply to the first start only; after that the checkpoint decides. At volume, pass
    `minPartitions` (the record key puts one market and side into one topic partition, and this
    splits a long partition over several tasks) and `maxOffsetsPerTrigger`.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **{name: str(value) for name, value in options.items()},
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    **options: str | int,
) -> DataFrame:
    """Stream of records: key, value, topic, partition, offset, timestamp, timestampType."""
    settings = topic_options(servers, topic, starting_offsets, **options)
    return spark.readStream.format("kafka").options(**settings).load()
