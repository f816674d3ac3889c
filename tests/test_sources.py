from __future__ import annotations

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tidefare.operators import trips
from tidefare.session import scratch_path, scratch_root
from tidefare.sources import requests, tables
from tidefare.sources.trips import (
    read_features,
    read_trips_csv,
    read_trips_parquet,
)

HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
    "pickup_longitude,pickup_latitude,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,fare_amount"
)
LINES = [
    "1,2016-03-01 08:00:00,2016-03-01 08:20:00,1,5.0,-73.99,40.71,N,-73.95,40.75,12.5",
    "2,2016-03-05 23:10:00,2016-03-05 23:40:30,2.0,7.5,-73.98,40.72,N,-73.94,40.76,20",
    "1,not a time,2016-03-01 08:20:00,x,abc,-73.99,40.71,N,-73.95,40.75,NaN",
    "1,2016-03-02 12:00:00,2016-03-02 12:10:00,1,,,,N,,,8",
]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_csv_columns_are_found_by_name(spark, csv):
    rows = read_trips_csv(spark, csv, "VendorID").collect()
    assert [row.VendorID for row in rows] == ["1", "2", "1", "1"]
    first, second, third, fourth = rows
    assert (first.trip_distance, first.fare_amount, first.passenger_count) == (5.0, 12.5, 1)
    assert (first.pickup_longitude, first.dropoff_latitude) == (-73.99, 40.75)
    assert second.passenger_count == 2
    assert (third.pickup_dt, third.trip_distance, third.fare_amount, third.passenger_count) == (None,) * 4
    assert (fourth.trip_distance, fourth.pickup_longitude, fourth.dropoff_latitude) == (None,) * 3


def test_csv_to_labels(spark, csv):
    rows = trips.labelled_trips(read_trips_csv(spark, csv)).orderBy("pickup_dt").collect()
    assert [(row.hour, row.is_weekend, row.surge_multiplier) for row in rows] == [
        (8, 0, 2.5), (23, 1, 3.2),
    ]
    assert [row.trip_duration_min for row in rows] == [20.0, 30.5]
    assert [row.avg_speed_mph for row in rows] == [15.0, 14.75]


def test_nan_fare_is_not_a_positive_fare(spark):
    rows = spark.createDataFrame([(1, float("nan")), (2, 5.0)], "trip int, fare_amount double")
    full = rows.selectExpr(
        "trip", "fare_amount", "timestamp'2024-01-01 12:00:00' AS tpep_pickup_datetime",
        "timestamp'2024-01-01 12:30:00' AS tpep_dropoff_datetime", "3.0D AS trip_distance",
        "1 AS passenger_count", "1D AS pickup_longitude", "1D AS pickup_latitude",
        "1D AS dropoff_longitude", "1D AS dropoff_latitude",
    )
    path = scratch_path(spark, "nan")
    full.write.parquet(path)
    kept = trips.labelled_trips(read_trips_parquet(spark, path, "trip"))
    assert [row.trip for row in kept.collect()] == [2]


def test_csv_parses_only_the_used_columns(spark, csv):
    plan = plan_text(read_trips_csv(spark, csv).select("trip_distance"))
    assert "ReadSchema: struct<trip_distance:string>" in plan


def test_csv_files_must_share_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    swapped = HEADER.replace("trip_distance", "x").replace("fare_amount", "trip_distance")
    (tmp_path / "b.csv").write_text("\n".join([swapped.replace("x,", "fare_amount,"), *LINES]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_trips_csv(spark, str(tmp_path)).collect()


def test_feature_filters_reach_the_scan(spark, small):
    from conformance.queries import features_roundtrip

    features = features_roundtrip(spark, small)
    plan = plan_text(features.filter("trip_distance > 3 AND surge_multiplier = 2.5").select("fare_amount"))
    assert "GreaterThan(trip_distance,3.0)" in plan
    assert "EqualTo(surge_multiplier,2.5)" in plan
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert schema.count(":") == 3


def test_cleaning_rules_on_stored_columns_reach_the_scan(spark, small):
    from conformance import fixtures

    path = scratch_path(spark, "raw")
    fixtures.raw_trips(spark, small).write.parquet(path)
    plan = plan_text(trips.labelled_trips(spark.read.parquet(path)))
    pushed = plan.split("PushedFilters: ")[1].splitlines()[0]
    for condition in (
        "GreaterThanOrEqual(trip_distance,0.1)", "LessThanOrEqual(trip_distance,100.0)",
        "GreaterThan(fare_amount,0.0)", "GreaterThan(passenger_count,0)",
        "IsNotNull(pickup_longitude)", "IsNotNull(pickup_latitude)",
    ):
        assert condition in pushed


@pytest.mark.parametrize("files, most_rows", [(1, 0), (4, 0), (16, 0), (1, 300), (4, 7)])
def test_the_stored_sample_does_not_depend_on_files(spark, small, files, most_rows, request):
    from conformance import fixtures
    from tidefare.plans.sample import stored_sample

    ordered = fixtures.raw_trips_as_exported(spark, small).repartitionByRange(files, "trip_id").sortWithinPartitions("trip_id")
    csv, copy, out = (scratch_path(spark, name) for name in ("csv", "copy", "sample"))
    ordered.write.option("header", True).csv(csv)
    # A task may store its part in many files.
    spark.conf.set("spark.sql.files.maxRecordsPerFile", most_rows)
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.files.maxRecordsPerFile"))
    found = stored_sample(spark, csv, copy, out, block_rows=100, per_block=10, max_blocks=5)
    assert 0 < found.count() <= 50
    rows = sorted(map(tuple, found.collect()))
    assert rows == _samples.setdefault("rows", rows)


_samples: dict[str, list] = {}


def test_cached_table_is_built_once(spark):
    path, built = scratch_path(spark, "cached"), []

    def build():
        built.append(1)
        return spark.range(10)

    assert tables.cached_table(spark, path, build).count() == 10
    assert tables.cached_table(spark, path, build).count() == 10
    assert built == [1]


def test_a_half_written_table_is_built_again(spark, tmp_path):
    path = tmp_path / "table"
    spark.range(3).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    assert tables.cached_table(spark, str(path), lambda: spark.range(10)).count() == 10


def test_kafka_options():
    assert requests.kafka_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "ride_requests",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    limited = requests.kafka_options("b", topic="ride-requests", max_offsets_per_trigger=10)
    assert (limited["subscribe"], limited["maxOffsetsPerTrigger"]) == ("ride-requests", "10")


def test_scratch_paths_follow_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (configured or scratch_root(spark))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_features_can_be_partitioned(spark, small):
    from conformance import fixtures
    from tidefare.sinks.tables import write_features

    features = trips.feature_table(fixtures.clean_labelled(spark, small), "trip_id")
    path = scratch_path(spark, "by-month")
    write_features(features, path, partition_by="month")
    stored = read_features(spark, path, "trip_id")
    assert stored.columns == features.columns
    assert stored.exceptAll(features).count() == 0
    assert stored.count() == features.count()


def test_column_report_counts_rows_and_nulls(spark):
    frame = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "c", None)], "`a.b` long, nulls_0 string, rows double")
    of = lambda rows: sorted(map(tuple, trips.column_report(rows).collect()))
    assert of(frame) == [(0, "a.b", "bigint", 3, 0), (1, "nulls_0", "string", 3, 1), (2, "rows", "double", 3, 3)]
    assert {row[3:] for row in of(frame.limit(0))} == {(0, 0)}


def test_feature_schema_reads_the_stored_table(spark, small):
    from conformance.queries import feature_counts, feature_schema

    report = feature_schema(spark, small).collect()
    counts = feature_counts(spark, small).collect()
    assert [(row.name, row.type) for row in counts] == [(row.name, row.type) for row in report]
    assert {row.rows for row in counts} != {0} and "Scan parquet" in plan_text(feature_counts(spark, small))


def test_schema_report(spark, small):
    from conformance import fixtures

    raw = fixtures.raw_trips(spark, small)
    report = trips.schema_report(raw).orderBy("position").collect()
    assert [(row.name, row.type) for row in report] == raw.dtypes
