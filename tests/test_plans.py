"""Whole jobs, and the shape of every query's plan."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from conformance import fixtures
from conformance.queries import QUERIES, VIEW, registered
from tidefare.functions.calendar import DAY_NAMES
from tidefare.functions.surge import TRIP_LEVELS
from tidefare.operators import dashboard, fares, trips
from tidefare.operators.cells import trip_cells
from tidefare.operators.dashboard import FilterSpec
from tidefare.plans import dashboard as dashboard_plan
from tidefare.plans.batch import run_batch
from tidefare.plans.sample import stored_sample
from tidefare.schemas import FEATURE_COLUMNS, FEATURES
from tidefare.session import scratch_path

WRITES_OR_FITS = {name for name in QUERIES if name.startswith("rf_")}


@pytest.fixture(scope="module")
def batch(spark, gate):
    return run_batch(fixtures.raw_trips(spark, gate), scratch_path(spark, "batch"), "trip_id")


@pytest.fixture(scope="module")
def clean_rows(batch):
    return [row.asDict() for row in trips.with_day_names(batch.features).collect()]


def test_batch_counts_and_schema(batch):
    assert (batch.raw_rows, batch.clean_rows) == (10_000, 7_486)
    assert batch.features.count() == batch.clean_rows
    assert batch.features.drop("trip_id").dtypes == [(f.name, f.dataType.simpleString()) for f in FEATURES]


def test_batch_reports_against_brute_force(batch, clean_rows):
    def grouped(rows, *keys):
        groups = defaultdict(list)
        for row in rows:
            groups[tuple(row[key] for key in keys)].append(row)
        return groups

    def close(found, rows, column, digits):
        exact = math.fsum(row[column] for row in rows) / len(rows)
        return abs(found - exact) <= 0.5 * 10 ** -digits + 1e-9

    by_hour = grouped(clean_rows, "hour")
    found = batch.reports["surge_by_hour"].collect()
    surges = [row.avg_surge for row in found]
    assert len(found) == 10 and surges == sorted(surges, reverse=True)
    top = sorted((math.fsum(r["surge_multiplier"] for r in rows) / len(rows) for rows in by_hour.values()))
    assert abs(min(surges) - top[-10]) < 0.001
    for row in found:
        rows = by_hour[(row.hour,)]
        assert row.trip_count == len(rows)
        assert close(row.avg_surge, rows, "surge_multiplier", 3)
        assert close(row.avg_fare, rows, "fare_amount", 2)
        assert close(row.avg_distance, rows, "trip_distance", 2)

    placed = [r | {"x": round(r["pickup_longitude"], 2), "y": round(r["pickup_latitude"], 2)} for r in clean_rows]
    areas = batch.reports["top_pickup_areas"].collect()
    counts = Counter((r["x"], r["y"]) for r in placed)
    assert [row.total_trips for row in areas] == sorted(counts.values(), reverse=True)[:15]

    for row in batch.reports["weekend_vs_weekday"].collect():
        rows = grouped(clean_rows, "day_type")[(row.day_type,)]
        assert row.total_trips == len(rows)
        assert close(row.avg_surge, rows, "surge_multiplier", 3)
        assert close(row.avg_duration_min, rows, "trip_duration_min", 1)

    windows = batch.reports["peak_hour_windows"].collect()
    cells = grouped(clean_rows, "hour", "day_of_week")
    assert len(windows) == 20
    for row in windows:
        rows = cells[(row.hour, row.day_of_week)]
        assert row.hour in {0, 1, 7, 8, 9, 17, 18, 19, 22, 23}
        assert row.trip_count == len(rows)
        assert row.max_surge == max(r["surge_multiplier"] for r in rows)
        assert close(row.avg_speed_mph, rows, "avg_speed_mph", 1)


def test_percentiles_equal_the_approximate_ones(batch):
    fractions = [0.25, 0.5, 0.75, 0.9, 0.99]
    sketch = batch.features.agg(
        F.percentile_approx("surge_multiplier", fractions), F.stddev("surge_multiplier")
    ).first()
    row = batch.reports["surge_percentiles"].first()
    assert [row.p25, row.median, row.p75, row.p90, row.p99] == sketch[0]
    assert math.isclose(row.std_dev, sketch[1], abs_tol=0.0005)


def test_the_view_answers_sql(spark, batch):
    busy = spark.sql("SELECT count(*) AS n FROM trips WHERE surge_multiplier >= 2.5 AND is_weekend = 0")
    assert busy.first().n == batch.cells.filter("surge_multiplier >= 2.5 AND is_weekend = 0").agg(
        F.sum("trips")
    ).first()[0]


def test_reports_of_one_trip_and_of_none(spark, batch):
    one = trip_cells(batch.features.filter("trip_id = 0").limit(1))
    row = batch_report(one, "surge_percentiles").first()
    assert row.std_dev is None and row.p25 == row.p99 == row.max_surge == row.mean
    none = trip_cells(batch.features.filter("hour > 99"))
    assert batch_report(none, "surge_percentiles").first().mean is None
    assert batch_report(none, "surge_by_hour").count() == 0


def batch_report(cells, name):
    from tidefare.plans.batch import CELL_REPORTS

    return CELL_REPORTS[name](cells)


def test_cells_are_few_and_whole(batch):
    assert batch.cells.count() <= 7 * 24 * 8
    assert batch.cells.agg(F.sum("trips")).first()[0] == batch.clean_rows


def test_clean_rows_are_raw_rows(spark, gate, batch):
    raw = fixtures.raw_trips(spark, gate)
    assert batch.features.join(raw, "trip_id", "left_anti").count() == 0
    assert {row[0] for row in batch.features.select("surge_multiplier").distinct().collect()} == set(TRIP_LEVELS)


@pytest.mark.parametrize("spec", [
    FilterSpec(), VIEW, FilterSpec(day_type="Weekend Only"), FilterSpec(days=("Sun",), surge_levels=(3.2, 3.0)),
], ids=["all", "view", "weekend", "sunday"])
def test_dashboard_against_brute_force(batch, clean_rows, spec):
    levels = set(TRIP_LEVELS if spec.surge_levels is None else spec.surge_levels)
    wanted = {"All": (0, 1), "Weekday Only": (0,), "Weekend Only": (1,)}[spec.day_type]
    shown = [
        row for row in clean_rows
        if row["day_name"] in spec.days and spec.first_hour <= row["hour"] <= spec.last_hour
        and row["surge_multiplier"] in levels and row["is_weekend"] in wanted
    ]
    found = dashboard_plan.cell_datasets(batch.cells, spec)
    surges = [row["surge_multiplier"] for row in shown]

    kpi = found["kpis"].first()
    assert (kpi.total_trips, kpi.max_surge) == (len(shown), max(surges))
    assert math.isclose(kpi.avg_surge, np.mean(surges))
    assert math.isclose(kpi.avg_fare, np.mean([row["fare_amount"] for row in shown]))
    assert math.isclose(kpi.avg_distance, np.mean([row["trip_distance"] for row in shown]))

    def means(*keys):
        groups = defaultdict(list)
        for row in shown:
            groups[tuple(row[key] for key in keys)].append(row["surge_multiplier"])
        return {key: np.mean(values) for key, values in groups.items()}

    hourly = found["hourly"].collect()
    assert [row.hour for row in hourly] == list(range(24))
    by_hour = means("hour")
    for row in hourly:
        if (row.hour,) in by_hour:
            assert math.isclose(row.avg_surge, by_hour[(row.hour,)])
        else:
            assert row.avg_surge is None and row.band == "low"

    share = found["share"].collect()
    assert {row.surge_multiplier: row.trips for row in share} == Counter(surges)
    assert math.isclose(sum(row.share_pct for row in share), 100.0)

    by_cell = means("dow_monday", "hour")
    heat = {
        (row.dow_monday, hour): row[f"h{hour:02d}"]
        for row in found["heatmap"].collect() for hour in range(24) if row[f"h{hour:02d}"] is not None
    }
    assert heat.keys() == by_cell.keys()
    assert all(math.isclose(heat[key], by_cell[key]) for key in heat)

    lines = {(r.is_weekend, r.hour): r.avg_surge for r in found["weekday_weekend"].collect()}
    expected = means("is_weekend", "hour")
    assert lines.keys() == expected.keys()
    assert all(math.isclose(lines[key], expected[key]) for key in lines)

    boxes = found["box"].collect()
    assert [row.day_name for row in boxes] == [d for d in DAY_NAMES if d in {r["day_name"] for r in shown}]
    for row in boxes:
        values = np.array([r["surge_multiplier"] for r in shown if r["day_name"] == row.day_name])
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        assert np.allclose([row.q1, row.median, row.q3], [q1, median, q3])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert math.isclose(row.whisker_low, min(values[values >= low].min(), q1))
        assert math.isclose(row.whisker_high, max(values[values <= high].max(), q3))
        assert row.outliers == ((values < low) | (values > high)).sum()

    assert [row[0] for row in found["levels"].collect()] == sorted(TRIP_LEVELS)


def test_an_empty_view(batch):
    nothing = FilterSpec(days=())
    assert not dashboard.has_rows(dashboard.apply_filter(batch.cells, nothing))
    assert dashboard.has_rows(dashboard.apply_filter(batch.cells, FilterSpec()))
    found = dashboard_plan.cell_datasets(batch.cells, nothing)
    kpi = found["kpis"].first()
    assert (kpi.total_trips, kpi.avg_surge, kpi.max_surge) == (0, None, None)
    assert found["share"].count() == found["box"].count() == found["heatmap"].count() == 0
    assert found["hourly"].count() == 24
    assert dashboard.surge_heatmap_pivot(batch.cells.limit(0)).count() == 7


def test_unknown_day_type_is_refused():
    with pytest.raises(ValueError):
        FilterSpec(day_type="Weekdays").condition()


def test_trip_and_prediction_datasets(spark, gate, batch, clean_rows):
    named = trips.with_day_names(batch.features)
    found = dashboard_plan.trip_datasets(named, "trip_id", spec=VIEW)
    preview = found["preview"].collect()
    assert len(preview) == 500
    surges = [row.surge_multiplier for row in preview]
    assert surges == sorted(surges, reverse=True)
    points = found["fare_points"].collect()
    assert points and all(row.fare_amount < 60 and row.trip_distance < 20 for row in points)

    scored = dashboard_plan.prediction_datasets(fixtures.predictions(spark, gate), "trip_id", n=200)
    assert scored["points"].count() == 200
    assert scored["preview"].count() == 100
    rows = scored["points"].collect()
    low, high = scored["limits"].first()
    assert math.isclose(low, min(min(r.label, r.prediction) for r in rows) - 0.05)
    assert math.isclose(high, max(max(r.label, r.prediction) for r in rows) + 0.05)
    error = scored["points_error"].first()
    assert math.isclose(error.rmse, np.sqrt(np.mean([(r.label - r.prediction) ** 2 for r in rows])))
    assert scored["overall_error"].first().rows > 200


def test_fare_trend_equals_polyfit(batch, clean_rows):
    points = fares.plot_range(batch.features)
    pairs = [(r["trip_distance"], r["fare_amount"]) for r in clean_rows
             if r["fare_amount"] < 60 and r["trip_distance"] < 20]
    slope, intercept = np.polyfit(*zip(*pairs, strict=True), 1)
    trend = fares.fare_trend(points).first()
    assert math.isclose(trend.slope, slope, abs_tol=1e-9)
    assert math.isclose(trend.intercept, intercept, rel_tol=1e-9)
    line = fares.trend_line(fares.fare_trend(points)).orderBy("step").collect()
    assert np.allclose([row.trip_distance for row in line], np.linspace(0, 20, 100))
    assert np.allclose([row.fare_amount for row in line], np.linspace(0, 20, 100) * slope + intercept)


def test_stored_cells_are_built_once(spark, batch):
    path = scratch_path(spark, "cells")
    first = dashboard_plan.stored_cells(spark, batch.features, path)
    second = dashboard_plan.stored_cells(spark, batch.features.limit(0), path)
    assert first.agg(F.sum("trips")).first() == second.agg(F.sum("trips")).first()
    assert first.rdd.getNumPartitions() == 1


def test_stored_sample_from_csv(spark, gate):
    csv, copy, sample = (scratch_path(spark, name) for name in ("csv", "copy", "sample"))
    raw = fixtures.raw_trips_as_exported(spark, gate)
    raw.repartition(4).write.option("header", True).csv(csv)
    found = stored_sample(spark, csv, copy, sample, block_rows=1000, per_block=100)
    assert found.columns == list(FEATURE_COLUMNS)
    # 4 files of 2,500 rows: three blocks each, 100 rows from every block before cleaning.
    assert 700 < found.count() < 1200
    assert stored_sample(spark, "no such file", copy, sample).count() == found.count()
    again = stored_sample(
        spark, csv, scratch_path(spark, "copy"), scratch_path(spark, "sample"), 1000, 100
    )
    assert again.exceptAll(found).count() == found.exceptAll(again).count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_OR_FITS))
def test_plans_have_no_cross_join_and_no_python(spark, small, name):
    plan = plan_text(registered()[name](spark, small))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in plan
