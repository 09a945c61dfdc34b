"""Row ids against the standard library."""

import uuid

from pyspark.sql import functions as F

from tapeline.functions.uuids import time_uuid, uuid_millis

GREGORIAN = 0x01B21DD213814000


def test_ids_are_version_1_unique_and_hold_the_time(spark):
    millis = 1_610_100_000_123
    made = spark.range(20_000).select(
        time_uuid(F.lit(millis), F.col("id"), F.lit("x")).alias("uuid")
    )
    ids = [uuid.UUID(row.uuid) for row in made.collect()]
    assert len(set(ids)) == len(ids)
    assert {value.version for value in ids} == {1}
    assert {value.variant for value in ids} == {uuid.RFC_4122}
    assert {(value.time - GREGORIAN) // 10_000 for value in ids} == {millis}
    assert {row[0] for row in made.select(uuid_millis(F.col("uuid"))).collect()} == {millis}


def test_same_row_same_id_other_time_other_id(spark):
    first, again, later = spark.range(1).select(
        time_uuid(F.lit(1_000), F.lit("a")),
        time_uuid(F.lit(1_000), F.lit("a")),
        time_uuid(F.lit(1_001), F.lit("a")),
    ).first()
    assert first == again != later


def test_times_around_the_epoch(spark):
    times = spark.createDataFrame([(0,), (-1,), (9223372036854,)], "ms bigint")
    rows = times.select("ms", time_uuid(F.col("ms")).alias("uuid")).withColumn(
        "back", uuid_millis(F.col("uuid"))
    )
    for row in rows.collect():
        assert row.back == row.ms
        assert (uuid.UUID(row.uuid).time - GREGORIAN) // 10_000 == row.ms
