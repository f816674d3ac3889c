"""Feeds that several tasks write, a slot of time at each step."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from conformance import fixtures
from conformance.queries import QUERIES

ROWS, PARTS = 400, 4


def stored_events(spark, folder):
    """Events of ten hours in four files, dealt so that every file has some of every hour."""
    rows = spark.range(0, ROWS, 1, PARTS).selectExpr(
        "id AS event_id", "timestampadd(SECOND, cast((id * 37) % 400 * 90 AS int), timestamp_ntz'2024-01-01 00:00:00') AS ts", "id % 9 AS user_id",
        "'view' AS event_type", "cast(id AS double) AS value", "concat('{\"k\": ', id % 50, '}') AS props",
    )
    rows.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_no_task_writes_a_whole_slot_of_replays(spark, tmp_path):
    folder, feed = stored_events(spark, tmp_path / "tables"), tmp_path / "feed"
    spark.conf.set("spark.sql.files.openCostInBytes", 128 * 1024 * 1024)
    try:
        next(iter(fixtures.feed_with_replays(spark, folder, str(feed))))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # Each of the four files is read by tasks of its own, once for each copy.
    assert len(list(feed.glob("part-*"))) == 2 * PARTS
    found = Counter(row.event_id for row in spark.read.text(str(feed)).select(F.get_json_object("value", "$.event_id").alias("event_id")).collect())
    assert len(found) > ROWS / 8 and set(found.values()) == {2}


def test_replays_of_many_files_are_priced_once(spark, tmp_path):
    folder = stored_events(spark, tmp_path / "tables")
    priced = QUERIES["stream_event_surge_replayed"](spark, folder)
    assert Counter(row.source_event_id for row in priced.collect()) == Counter(str(number) for number in range(ROWS))
