"""As-of join, moving frames, sessions, quantiles, frequent areas and replays against plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tidefare.operators import hitters, quantiles
from tidefare.operators.asof import asof_join
from tidefare.operators.moving import moving_demand
from tidefare.streaming.replays import once_each
from tidefare.streaming.sessions import ride_sessions

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]


# As-of

def brute_asof(left, right):
    out = Counter()
    for row in left:
        known = [other for other in right if row[1] is not None and row[2] is not None and other[0] == row[1] and other[1] is not None and other[1] <= row[2]]
        # The latest; among equals the greatest values, nulls least.
        best = max(known, key=lambda other: (other[1], other[2] is not None, other[2] or 0, other[3] is not None, other[3] or ""), default=(None,) * 4)
        out[row + best[2:]] += 1
    return out


@pytest.mark.parametrize("slot_rows", [1_000_000, 40, 3])
def test_asof_join_equals_brute_force(spark, slot_rows):
    draw = random.Random(7)
    # Zone "hot" has most rows; times repeat; some keys and times are null; one zone is on one side only.
    zones = ["hot"] * 12 + ["cold", "left", None]
    left = [(k, draw.choice(zones), at(draw.choice([None, *range(60)] if k % 9 == 0 else range(200)))) for k in range(300)] + [(0, "hot", at(5))] * 2
    right = [(draw.choice(zones[:-2] + [None, "right"]), at(draw.choice([None, *range(0, 190, 2)])), draw.choice([None, 1, 2, 3]), draw.choice([None, "a", "b"])) for _ in range(200)]
    a = spark.createDataFrame(left, "slot long, zone string, micros timestamp")
    b = spark.createDataFrame(right, "zone string, told timestamp, found int, name string")
    joined = asof_join(a, b, "zone", time="micros", others_time="told", values=("found", "name"), slot_rows=slot_rows)
    assert joined.columns == ["slot", "zone", "micros", "found", "name"]
    assert Counter(rows_of(joined)) == brute_asof(left, right)


def test_asof_join_of_empty_sides_and_clashing_values(spark):
    a = spark.createDataFrame([(1, "x", at(3))], "id long, zone string, time timestamp")
    none = spark.createDataFrame([], "zone string, told timestamp, value int")
    assert rows_of(asof_join(a, none, "zone", time="time", others_time="told", values=("value",))) == [(1, "x", at(3), None)]
    assert rows_of(asof_join(a.limit(0), none, "zone", time="time", others_time="told", values=("value",))) == []
    with pytest.raises(ValueError, match="both sides"):
        asof_join(a, none.withColumnRenamed("value", "id"), "zone", time="time", others_time="told", values=("id",))


def test_asof_join_has_no_range_join(spark):
    a = spark.range(5000).select(F.col("id"), F.lit("hot").alias("zone"), F.timestamp_seconds("id").alias("time"))
    b = spark.range(5000).select(F.lit("hot").alias("zone"), F.timestamp_seconds("id").alias("told"), F.col("id").alias("value"))
    joined = asof_join(a, b, "zone", time="time", others_time="told", values=("value",), slot_rows=500)
    plan = plan_text(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # The hot zone is spread: its window is keyed by slot too.
    assert joined.where("value <> id").count() == 0 and "slot" in plan


# Moving frames and sessions

def test_moving_demand_equals_brute_force(spark):
    draw = random.Random(3)
    rows = [(k, draw.choice(["hot", "hot", "cold", None]), at(draw.randrange(0, 400)), draw.choice([None, 1, 5]), draw.choice([None, 2, 4])) for k in range(250)]
    rows.append((250, "hot", None, 1, 1))
    frame = spark.createDataFrame(rows, "event_id long, zone string, event_time timestamp, ride_requests int, available_drivers int")
    expected = {}
    for key, zone, time, *_ in rows[:-1]:
        recent = [row for row in rows[:-1] if row[1] == zone and time - dt.timedelta(minutes=30) <= row[2] <= time]
        demand, drivers = ([row[k] for row in recent if row[k] is not None] for k in (3, 4))
        expected[key] = (len(recent), sum(demand) if demand else None, sum(drivers) / len(drivers) if drivers else None)
    for minutes in (30, 47, 10_000):
        moved = moving_demand(frame, 30, minutes)
        assert moved.columns == [*frame.columns, "recent_requests", "recent_demand", "recent_drivers"]
        found = {row.event_id: (row.recent_requests, row.recent_demand, row.recent_drivers) for row in moved.collect()}
        assert found == expected
    with pytest.raises(ValueError):
        moving_demand(frame, 30, 29)


def test_sessions_end_after_a_gap(spark):
    rows = [("a", 0), ("a", 29), ("a", 59), ("a", 90), ("a", 91), ("b", 5), (None, 1), (None, 2), ("a", None)]
    frame = spark.createDataFrame([(user, at(minute), f"z{minute}", 1) for user, minute in rows], "user_id string, event_time timestamp, zone string, ride_requests int")
    found = {(row.user_id, row.session_start): (row.session_end, row.requests, row.first_zone, row.last_zone) for row in ride_sessions(frame).collect()}
    # The pauses of `a`: 29, 30, 31 (a new session), 1.
    assert found == {
        ("a", at(0)): (at(89), 3, "z0", "z59"), ("a", at(90)): (at(121), 2, "z90", "z91"),
        ("b", at(5)): (at(35), 1, "z5", "z5"), (None, at(1)): (at(32), 2, "z1", "z2"),
    }


def test_tables_drop_replays_but_keep_what_has_no_id_or_time(spark):
    rows = [("1", at(0)), ("1", at(0)), ("2", at(1)), (None, at(1)), (None, at(1)), ("3", None), ("3", None)]
    kept = once_each(spark.createDataFrame(rows, "event_id string, event_time timestamp"))
    assert Counter(rows_of(kept)) == Counter([("1", at(0)), ("2", at(1)), (None, at(1)), (None, at(1)), ("3", None), ("3", None)])


# Quantiles and frequent areas

def exact(values, fraction):
    ordered = sorted(values)
    whole = int(fraction * len(ordered))
    return ordered[max(0, (whole if whole >= fraction * len(ordered) else whole + 1) - 1)]


@pytest.mark.parametrize("few", [1, 50, 100_000])
def test_exact_quantiles_of_ties_nulls_and_long_tails(spark, few):
    draw = random.Random(11)
    rows = [(draw.choice([None, draw.expovariate(0.01), 7.0, 7.0]), float(draw.randrange(3)), None, -1e9 if k == 0 else draw.random()) for k in range(3000)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    measures = {name: name for name in "abcd"}
    fractions = {"least": 0.0, "p25": 0.25, "median": 0.5, "p99": 0.99, "most": 1.0}
    found = {row.measure: row for row in quantiles.exact_quantiles(frame, fractions, measures, few=few).collect()}
    assert set(found) == {"a", "b", "d"}
    for k, name in enumerate("abcd"):
        values = [row[k] for row in rows if row[k] is not None]
        for label, fraction in fractions.items() if values else ():
            assert found[name][label] == exact(values, fraction)
    assert quantiles.exact_quantiles(frame.limit(0), fractions, measures).collect() == []


def test_a_sketch_that_misses_costs_a_pass_and_no_rank(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "RANK_ERROR", 1e-4)  # intervals far narrower than the sketch is sharp
    frame = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("a"))
    values = [k * 7919 % 20_011 for k in range(20_000)]
    found = quantiles.exact_quantiles(frame, {"p25": 0.25, "p90": 0.9}, {"a": "a"}, few=10, size=8).first()
    assert (found.p25, found.p90) == (exact(values, 0.25), exact(values, 0.9))


def areas(rows, digits, top):
    count = Counter((round(lon, digits), round(lat, digits)) for lon, lat in rows)
    return sorted(((lon, lat, n) for (lon, lat), n in count.items()), key=lambda row: (-row[2], row[0], row[1]))[:top]


@pytest.mark.parametrize("flat, tracked", [(False, 400), (True, 60), (True, 10_000)], ids=["proven", "too flat", "all tracked"])
def test_top_areas_equal_a_full_count(spark, flat, tracked):
    draw = random.Random(5)
    rows = []
    for k in range(6000):
        hot = not flat and draw.random() < 0.7
        rows.append((-74.0 - (draw.randrange(8) if hot else draw.randrange(40)) / 10_000, 40.7 + (0 if hot else draw.randrange(40)) / 10_000))
    frame = spark.createDataFrame([(lon, lat, 1.0, 10.0) for lon, lat in rows] + [(None, 40.0, 1.0, 1.0)], "pickup_longitude double, pickup_latitude double, surge_multiplier double, fare_amount double")
    found = [(row.area_lon, row.area_lat, row.total_trips) for row in hitters.top_areas(frame, 4, 5, tracked).collect()]
    assert found == areas(rows, 4, 5)
    assert hitters.top_areas(frame.limit(0)).collect() == []
