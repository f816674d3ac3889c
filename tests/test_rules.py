"""Rule tables: at, just below and above each threshold, and null."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidefare.functions import calendar, surge, trip
from tidefare.operators.trips import clean


def evaluate(spark, schema, rows, column):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [row[0] for row in frame.orderBy("i").select(column).collect()]


TRIP_CASES = [
    # hour, is_weekend, speed, passengers, multiplier
    (6, 0, 30.0, 1, 1.0), (7, 0, 30.0, 1, 2.5), (9, 0, 30.0, 1, 2.5), (10, 0, 30.0, 1, 1.0),
    (16, 0, 30.0, 1, 1.0), (17, 0, 30.0, 1, 2.8), (19, 0, 30.0, 1, 2.8), (20, 0, 30.0, 1, 1.0),
    (21, 1, 30.0, 1, 1.0), (22, 1, 30.0, 1, 3.2), (23, 1, 30.0, 1, 3.2),
    (0, 1, 30.0, 1, 3.0), (2, 1, 30.0, 1, 3.0), (3, 1, 30.0, 1, 1.0),
    (8, 1, 30.0, 1, 1.0), (23, 0, 30.0, 1, 1.0), (1, 0, 30.0, 1, 1.0),
    (12, 0, 4.99, 1, 2.0), (12, 0, 5.0, 1, 1.6), (12, 0, 9.99, 1, 1.6), (12, 0, 10.0, 1, 1.0),
    (12, 0, 10.0, 4, 1.0), (12, 0, 10.0, 5, 1.4), (12, 0, 3.0, 6, 2.0), (8, 0, 3.0, 6, 2.5),
    (None, 0, 30.0, 1, 1.0), (8, None, 30.0, 1, 1.0), (12, 0, None, 5, 1.4), (12, 0, None, None, 1.0),
    (None, None, 4.0, None, 2.0),
]


def test_trip_surge(spark):
    found = evaluate(
        spark, "hour int, w int, speed double, people int", [case[:4] for case in TRIP_CASES],
        surge.trip_surge(F.col("hour"), F.col("w"), F.col("speed"), F.col("people")),
    )
    assert found == [case[4] for case in TRIP_CASES]
    assert set(found) <= set(surge.TRIP_LEVELS)


@pytest.mark.parametrize(("steps", "floor"), [(surge.WINDOW_LADDER, 1.0), (surge.EVENT_LADDER, 1.0)])
def test_ladders_switch_at_their_thresholds(spark, steps, floor):
    values, expected, below = [], [], floor
    for start, result in steps:
        values += [start - 0.001, start, start + 0.001]
        expected += [below, result, result]
        below = result
    values += [None, -1.0]
    expected += [floor, floor]
    found = evaluate(spark, "v double", [(v,) for v in values], surge.ladder(F.col("v"), steps, floor))
    assert found == expected


def test_window_ladder_values(spark):
    cases = [(0.99, 1.0), (1.0, 1.4), (1.3, 1.8), (1.8, 2.2), (2.5, 2.8), (3.5, 3.5), (9.0, 3.5)]
    found = evaluate(spark, "v double", [(v,) for v, _ in cases], surge.window_surge(F.col("v")))
    assert found == [expected for _, expected in cases]


def test_window_ratio_guards(spark):
    cases = [(10, 4.0, 2.5), (10, 0.0, None), (None, 4.0, None), (10, None, None), (1, 3.0, 0.33)]
    found = evaluate(
        spark, "r bigint, d double", [case[:2] for case in cases],
        surge.window_ratio(F.col("r"), F.col("d")),
    )
    assert found == [case[2] for case in cases]


EVENT_CASES = [
    # requests, drivers, weather code, special event, weekend, multiplier
    (10, 20, 0, False, False, 1.0), (20, 20, 0, False, False, 1.2), (26, 20, 0, False, False, 1.4),
    (36, 20, 0, False, False, 1.8), (50, 20, 0, False, False, 2.2), (70, 20, 0, False, False, 2.8),
    (100, 20, 0, False, False, 3.5), (99, 20, 0, False, False, 2.8),
    (10, 20, 1, False, False, 1.0), (10, 20, 2, False, False, 1.3), (10, 20, 3, False, False, 1.5),
    (10, 20, 7, False, False, 1.5), (10, 20, 0, True, False, 1.5), (10, 20, 0, False, True, 1.3),
    (10, 20, 3, True, True, 2.3), (100, 20, 3, True, True, 4.8), (5, 0, 0, False, False, 3.5),
    # what is missing counts as 50 requests, 20 drivers, clear weather, no event, a weekday
    (None, None, None, None, None, 2.2), (None, 50, None, None, None, 1.2), (100, None, None, None, None, 3.5),
]


def test_event_surge(spark):
    found = evaluate(
        spark, "r int, d int, w int, s boolean, e boolean", [case[:5] for case in EVENT_CASES],
        surge.event_surge(*(F.col(c) for c in "rdwse")),
    )
    assert found == [case[5] for case in EVENT_CASES]


def test_event_surge_is_capped(spark):
    steeper = ((1.0, 4.9),)
    capped = surge.event_surge(
        F.lit(100), F.lit(1), F.lit(3), F.lit(True), F.lit(True), steps=steeper
    )
    assert evaluate(spark, "x int", [(1,)], capped) == [5.0]


def test_period_flags(spark):
    hours = [*range(24), None]
    expected = {
        "is_morning_peak": {7, 8, 9},
        "is_evening_peak": {17, 18, 19, 20},
        "is_late_night": {22, 23, 0, 1, 2},
    }
    for name, inside in expected.items():
        found = evaluate(spark, "h int", [(h,) for h in hours], calendar.period_flag(F.col("h"), name))
        assert found == [int(h in inside) for h in hours]


def test_day_numbers_and_names(spark):
    # 2016-03-06 was a Sunday.
    found = evaluate(
        spark, "d string", [("2016-03-06",), ("2016-03-07",), (None,)],
        F.struct(
            F.dayofweek(F.to_date("d")),
            calendar.monday_first(F.dayofweek(F.to_date("d"))),
            calendar.day_name(calendar.monday_first(F.dayofweek(F.to_date("d")))),
            calendar.weekend_flag(F.to_date("d")),
        ),
    )
    assert [tuple(row) for row in found] == [
        (1, 6, "Sun", 1), (2, 0, "Mon", 0), (None, None, None, None),
    ]


def test_duration_is_the_decimal_rounding(spark):
    rows = [(seconds,) for seconds in [*range(-400, 11_000, 7), 59, 60, 61, 10_800, 10_801, None]]
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    end = F.timestamp_seconds(F.unix_timestamp(start) + F.col("s"))
    found = evaluate(spark, "s int", rows, F.struct(
        trip.duration_minutes(start, end).alias("fast"), F.round(F.col("s") / 60, 2).alias("plain"),
    ))
    assert all(row.fast == row.plain for row in found)


def test_speed_is_guarded(spark):
    cases = [(10.0, 30.0, 20.0), (10.0, 0.0, 0.0), (10.0, -5.0, 0.0), (10.0, None, 0.0), (1.0, 7.0, 8.57)]
    found = evaluate(
        spark, "d double, m double", [case[:2] for case in cases],
        trip.average_speed(F.col("d"), F.col("m")),
    )
    assert found == [case[2] for case in cases]


def test_bands(spark):
    cases = [(2.5, "high"), (2.49, "mid"), (1.5, "mid"), (1.49, "low"), (None, "low")]
    found = evaluate(spark, "v double", [(v,) for v, _ in cases], surge.surge_band(F.col("v")))
    assert found == [band for _, band in cases]
    cases = [(0.15, "high"), (0.149, "medium"), (0.05, "medium"), (0.049, "low")]
    found = evaluate(spark, "v double", [(v,) for v, _ in cases], surge.importance_band(F.col("v")))
    assert found == [band for _, band in cases]


GOOD_TRIP = {
    "trip_distance": 5.0, "fare_amount": 10.0, "trip_duration_min": 20.0, "avg_speed_mph": 15.0,
    "passenger_count": 1, "pickup_longitude": -73.9, "pickup_latitude": 40.7,
}
BOUNDS = [
    ("trip_distance", 0.1, True), ("trip_distance", 0.09, False), ("trip_distance", 100.0, True),
    ("trip_distance", 100.01, False), ("fare_amount", 0.01, True), ("fare_amount", 0.0, False),
    ("trip_duration_min", 1.0, True), ("trip_duration_min", 0.99, False),
    ("trip_duration_min", 180.0, True), ("trip_duration_min", 180.01, False),
    ("avg_speed_mph", 119.99, True), ("avg_speed_mph", 120.0, False),
    ("passenger_count", 1, True), ("passenger_count", 0, False),
    *[(name, None, False) for name in GOOD_TRIP],
]


def test_cleaning_bounds(spark):
    columns = ", ".join(
        f"{name} {'int' if name == 'passenger_count' else 'double'}" for name in GOOD_TRIP
    )
    rows = [(i, *{**GOOD_TRIP, name: value}.values()) for i, (name, value, _) in enumerate(BOUNDS)]
    kept = {row.i for row in clean(spark.createDataFrame(rows, f"i int, {columns}")).collect()}
    assert kept == {i for i, (_, _, keep) in enumerate(BOUNDS) if keep}
