"""Streams against the batch form of the same operators."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conformance import fixtures
from tidefare.plans import live
from tidefare.schemas import PRICED_EVENT
from tidefare.sinks import streams
from tidefare.sources.requests import read_json_files
from tidefare.streaming.events import as_messages, price_events
from tidefare.streaming.requests import bad_records, parse_requests, valid_requests
from tidefare.streaming.windows import demand_windows, window_surge

FILES = 6


def request(time, **fields):
    base = {"timestamp": time, "zone": "Uptown", "ride_requests": 10, "available_drivers": 5}
    return json.dumps(base | fields)


def bag(frame, *columns):
    return Counter(tuple(row) for row in frame.select(*(columns or sorted(frame.columns))).collect())


def write_feed(folder, chunks):
    folder.mkdir(exist_ok=True)
    for chunk in chunks:
        number = len(list(folder.glob("*.json")))
        path = folder / f"{number:03d}.json"
        path.write_text("\n".join(chunk) + "\n")
        os.utime(path, (1_700_000_000 + number * 60,) * 2)


@pytest.fixture(scope="module")
def feed(spark, small, tmp_path_factory):
    """The fixture messages as files in time order, one per micro-batch."""
    rows = fixtures.messages_from_events(fixtures.events(spark, small)).orderBy("event_id")
    values = [row.value for row in rows.collect()]
    size = -(-len(values) // FILES)
    folder = tmp_path_factory.mktemp("feed") / "messages"
    write_feed(folder, [values[i:i + size] for i in range(0, len(values), size)])
    return folder


def run_windows(spark, folder, out, **settings):
    messages = read_json_files(spark, str(folder), files_per_trigger=1)
    query = live.start_window_surge(
        messages, str(out / "windows"), str(out / "checkpoint"), trigger=None, **settings
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_restart_adds_nothing(spark, feed, tmp_path):
    query = run_windows(spark, feed, tmp_path)
    assert len([p for p in query.recentProgress if p.numInputRows]) == FILES
    found = bag(streams.latest_windows(spark, str(tmp_path / "windows")))
    batch = window_surge(valid_requests(parse_requests(spark.read.text(str(feed)))))
    assert found == bag(batch)
    assert streams.rows_read(query) == spark.read.text(str(feed)).count()
    again = run_windows(spark, feed, tmp_path)
    assert streams.rows_read(again) == 0
    assert bag(streams.latest_windows(spark, str(tmp_path / "windows"))) == found


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder = tmp_path / "feed"
    write_feed(folder, [
        [request("2024-01-01T10:00:00"), request("2024-01-01T10:04:00")],
        [request("2024-01-01T10:20:00")],
        # An hour old: its window has closed. Half a minute behind the newest: in time.
        [request("2024-01-01T09:00:00"), request("2024-01-01T10:19:30")],
    ])
    query = run_windows(spark, folder, tmp_path)
    assert streams.rows_dropped_late(query) == 1
    rows = {
        row.window_start.strftime("%H:%M"): row.total_requests
        for row in streams.latest_windows(spark, str(tmp_path / "windows")).collect()
    }
    assert rows == {"10:00": 20, "10:20": 10, "10:15": 10}


def test_an_updated_window_replaces_its_older_version(spark, tmp_path):
    folder = tmp_path / "feed"
    write_feed(folder, [
        [request("2024-01-01T10:01:00", ride_requests=5)],
        [request("2024-01-01T10:02:00", ride_requests=100)],
    ])
    run_windows(spark, folder, tmp_path, files=1)
    stored = spark.read.parquet(str(tmp_path / "windows"))
    assert stored.count() == 2
    # Two batches of rows and the empty one that closes old windows, a file each.
    assert len(stored.inputFiles()) == len(list((tmp_path / "windows").glob("run=*/*"))) == 3
    row = streams.latest_windows(spark, str(tmp_path / "windows")).collect()
    assert [(r.total_requests, r.avg_drivers, r.demand_supply_ratio, r.surge_multiplier) for r in row] == [
        (105, 5.0, 21.0, 3.5)
    ]


def test_windows_carry_the_earliest_weather(spark):
    values = [
        (request("2024-01-01T10:03:00", weather_code=2, is_weekend=True, event_id="a"),),
        (request("2024-01-01T10:01:00", weather_code=1, is_weekend=False, event_id="b"),),
        (request("2024-01-01T10:01:00", weather_code=None, zone=None),),
    ]
    requests = valid_requests(parse_requests(spark.createDataFrame(values, "value string")))
    rows = {row.zone: row for row in demand_windows(requests).collect()}
    assert (rows["Uptown"].weather_code, rows["Uptown"].is_weekend) == (1, False)
    assert rows[None].weather_code is None


def test_windows_aggregate_by_hash(spark, small):
    from conftest import plan_text

    plan = plan_text(window_surge(valid_requests(parse_requests(fixtures.messages(spark, small)))))
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_unparsable_messages_go_to_the_side(spark, tmp_path):
    folder = tmp_path / "feed"
    good = request("2024-01-01T10:01:00")
    bad = ["not json", '{"zone": "Uptown"}', request("half past ten"), "{"]
    write_feed(folder, [[good, *bad]])
    messages = read_json_files(spark, str(folder))
    out = str(tmp_path / "bad")
    live.start_bad_records(messages, out, str(tmp_path / "c"), trigger=None).awaitTermination()
    assert bag(spark.read.parquet(out)) == Counter((value,) for value in bad)
    parsed = parse_requests(spark.read.text(str(folder)))
    assert valid_requests(parsed).count() == 1
    assert bad_records(parsed).count() == len(bad)


def test_a_wrong_typed_field_is_null_alone(spark):
    value = '{"timestamp": "2024-01-01T10:00:00", "zone": "Uptown", "ride_requests": "many", "event_id": 7}'
    row = parse_requests(spark.createDataFrame([(value,)], "value string")).first()
    assert (row.zone, row.ride_requests, row.event_id) == ("Uptown", None, "7")


def test_event_stream_publishes_each_request_once(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for expected in (spark.read.text(str(feed)).count(), 0):
        messages = read_json_files(spark, str(feed), files_per_trigger=2)
        query = live.start_event_surge_files(messages, out, checkpoint, trigger=None)
        query.awaitTermination()
        assert streams.rows_read(query) == expected
    published = spark.read.parquet(out)
    event = F.from_json("value", PRICED_EVENT)
    found = published.select("key", event.alias("event")).select("key", "event.*").drop("timestamp")
    batch = price_events(parse_requests(spark.read.text(str(feed)))).drop("timestamp")
    assert bag(found) == bag(batch.withColumn("key", F.col("zone")))


def test_published_defaults_and_passed_through_nulls(spark):
    rows = spark.createDataFrame([("{}",), (request("2024-01-01T10:00:00", ride_requests=None),)], "value string")
    clock = F.lit("2024-02-03 04:05:06.789").cast("timestamp")
    empty, partial = (
        (row.key, json.loads(row.value))
        for row in as_messages(price_events(parse_requests(rows), clock)).collect()
    )
    assert empty == ("Unknown", {
        "timestamp": "2024-02-03T04:05:06.789000", "zone": "Unknown", "surge_multiplier": 2.2,
        "ride_requests": None, "available_drivers": None, "weather": "clear",
        "special_event": False, "base_fare_usd": 2.5, "effective_fare_usd": 5.5,
        "source_event_id": "",
    })
    # 50 assumed requests for 5 drivers.
    assert partial[1]["ride_requests"] is None and partial[1]["surge_multiplier"] == 3.5


def test_console_sink_runs(spark, feed, tmp_path):
    requests = valid_requests(parse_requests(read_json_files(spark, str(feed))))
    query = streams.console_windows(window_surge(requests), str(tmp_path / "c"), trigger=None)
    query.awaitTermination()
    assert query.exception() is None


def test_a_running_stream_can_be_stopped(spark, feed, tmp_path):
    messages = read_json_files(spark, str(feed))
    query = live.start_event_surge_files(
        messages, str(tmp_path / "out"), str(tmp_path / "c"), trigger="1 second"
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.text(str(feed)).count()


def test_a_new_checkpoint_neither_destroys_nor_hides(spark, tmp_path):
    for number, demand in enumerate((5, 70)):
        folder = tmp_path / f"feed{number}"
        write_feed(folder, [[request("2024-01-01T10:01:00", ride_requests=demand)]])
        live.start_window_surge(
            read_json_files(spark, str(folder)), str(tmp_path / "windows"), str(tmp_path / f"c{number}"), trigger=None
        ).awaitTermination()
    assert len(list((tmp_path / "windows").glob("run=*"))) == 2
    assert [row.total_requests for row in streams.latest_windows(spark, str(tmp_path / "windows")).collect()] == [70]
    streams.compact_windows(spark, str(tmp_path / "windows"), str(tmp_path / "compact"))
    assert [row.total_requests for row in streams.latest_windows(spark, str(tmp_path / "compact")).collect()] == [70]
    from conftest import plan_text

    assert "SortAggregate" not in plan_text(streams.latest_windows(spark, str(tmp_path / "compact")))


def test_a_counter_outlasts_the_last_hundred_triggers():
    from types import SimpleNamespace

    counter = streams.FeedCounter()
    for _ in range(150):
        state = SimpleNamespace(numRowsDroppedByWatermark=1)
        counter.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id="q", numInputRows=2, stateOperators=[state])))
    assert counter.read["q"] == 300 and counter.late["q"] == 150


def test_messages_without_a_time_are_priced_and_others_kept_apart(spark):
    from tidefare.streaming.requests import parsed_requests, unparsed_records

    rows = [("not json",), ('{"zone": "A", "ride_requests": 9, "available_drivers": 3}',), ("",), (None,)]
    parsed = parse_requests(spark.createDataFrame(rows, "value string"))
    assert [row.zone for row in price_events(parsed_requests(parsed)).collect()] == ["A"]
    assert unparsed_records(parsed).count() == 3 and valid_requests(parsed).count() == 0 and bad_records(parsed).count() == 4
