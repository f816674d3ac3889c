"""Trip cells: what reports and dashboards need of any number of trips.

The reports depend on trips only through counts and sums per (day, hour, weekend, surge
level). One partial-aggregated pass reduces the trips to at most 7 * 24 * 8 cells: each task
sends a row per cell, so it does not matter which cells hold most of the trips. Everything
computed from cells then costs nothing, at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefare.functions import calendar

MEASURES = {
    "fare": "fare_amount",
    "distance": "trip_distance",
    "duration": "trip_duration_min",
    "speed": "avg_speed_mph",
}


def trip_cells(trips: DataFrame) -> DataFrame:
    """Trips per (day, hour, weekend, surge level), with the sum and count of each measure."""
    sums = [F.sum(column).alias(f"{name}_sum") for name, column in MEASURES.items()]
    counts = [F.count(column).alias(f"{name}_trips") for name, column in MEASURES.items()]
    return (
        trips.groupBy("day_of_week", "hour", "is_weekend", "surge_multiplier")
        .agg(F.count(F.lit(1)).alias("trips"), *sums, *counts)
        .withColumn("dow_monday", calendar.monday_first(F.col("day_of_week")))
    )


def mean_of(measure: str) -> Column:
    """Mean of a measure over the trips of a group of cells."""
    return F.try_divide(F.sum(f"{measure}_sum"), F.sum(f"{measure}_trips"))


def mean_surge() -> Column:
    return F.try_divide(F.sum(F.col("surge_multiplier") * F.col("trips")), F.sum("trips"))


def surge_level_trips(cells: DataFrame, *keys: str) -> DataFrame:
    """Trips per surge level: at most 8 rows for each value of the keys."""
    return cells.groupBy(*keys, "surge_multiplier").agg(F.sum("trips").alias("trips"))
