"""The batch demand and surge reports.

All but the pickup-area report are computed from trip cells, so one pass over the trips
serves them all. Top-k reports add their keys to the sort, so ties have one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidefare.functions import calendar, trip
from tidefare.functions.numbers import steady_round
from tidefare.operators.cells import mean_of, mean_surge, surge_level_trips

# The hours of the peak-window report.
PEAK_REPORT_HOURS = (7, 8, 9, 17, 18, 19, 22, 23, 0, 1)
# Fractions of the distribution report.
REPORT_PERCENTILES = {"p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}


def surge_by_hour(cells: DataFrame, top: int = 10) -> DataFrame:
    """Hours with the highest mean surge."""
    return (
        cells.groupBy("hour")
        .agg(
            steady_round(mean_surge(), 3).alias("avg_surge"),
            steady_round(mean_of("fare"), 2).alias("avg_fare"),
            steady_round(mean_of("distance"), 2).alias("avg_distance"),
            F.sum("trips").alias("trip_count"),
        )
        .orderBy(F.desc("avg_surge"), "hour")
        .limit(top)
    )


def top_pickup_areas(trips: DataFrame, top: int = 15) -> DataFrame:
    """Pickup areas with the most trips. Tasks combine their own trips before the shuffle."""
    return (
        trips.groupBy(
            trip.grid(F.col("pickup_longitude")).alias("area_lon"),
            trip.grid(F.col("pickup_latitude")).alias("area_lat"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            steady_round(F.avg("surge_multiplier"), 3).alias("avg_surge"),
            steady_round(F.avg("fare_amount"), 2).alias("avg_fare"),
        )
        .orderBy(F.desc("total_trips"), "area_lon", "area_lat")
        .limit(top)
    )


def weekend_vs_weekday(cells: DataFrame) -> DataFrame:
    """Means and count for weekdays and for weekends."""
    return (
        cells.groupBy("is_weekend")
        .agg(
            steady_round(mean_surge(), 3).alias("avg_surge"),
            steady_round(mean_of("fare"), 2).alias("avg_fare"),
            steady_round(mean_of("distance"), 2).alias("avg_distance"),
            steady_round(mean_of("duration"), 1).alias("avg_duration_min"),
            F.sum("trips").alias("total_trips"),
        )
        .select(
            calendar.day_type(F.col("is_weekend")).alias("day_type"),
            "avg_surge", "avg_fare", "avg_distance", "avg_duration_min", "total_trips",
        )
        .orderBy(F.desc("avg_surge"), "day_type")
    )


def _at_fraction(fraction: float) -> Column:
    """Lowest level that at least this fraction of the trips does not exceed."""
    return F.min(F.when(F.col("seen") >= F.col("total") * fraction, F.col("surge_multiplier")))


def surge_percentiles(cells: DataFrame) -> DataFrame:
    """Percentiles, mean, sample deviation and maximum of surge.

    The percentiles are exact: with a handful of levels, running counts are both cheaper and
    sharper than a sketch, whose per-task buffers would all meet in one task.
    """
    # The unpartitioned frames cover one row per level.
    upward, everything = W.orderBy("surge_multiplier"), W.partitionBy()
    surge, trips = F.col("surge_multiplier"), F.col("trips")
    levels = surge_level_trips(cells).filter(surge.isNotNull()).withColumns({
        "seen": F.sum("trips").over(upward),
        "total": F.sum("trips").over(everything),
        "weighted": F.sum(surge * trips).over(everything),
    }).withColumn("mean", F.col("weighted") / F.col("total"))
    off_mean = surge - F.col("mean")
    variance = F.try_divide(F.sum(off_mean * off_mean * trips), F.sum(trips) - 1)
    return levels.agg(
        *[_at_fraction(fraction).alias(name) for name, fraction in REPORT_PERCENTILES.items()],
        steady_round(F.max("mean"), 3).alias("mean"),
        steady_round(F.sqrt(variance), 3).alias("std_dev"),
        F.max("surge_multiplier").alias("max_surge"),
    )


def peak_hour_windows(cells: DataFrame, top: int = 20) -> DataFrame:
    """Peak (hour, day) windows with the highest mean surge."""
    return (
        cells.filter(F.col("hour").isin(*PEAK_REPORT_HOURS))
        .groupBy("hour", "day_of_week")
        .agg(
            F.sum("trips").alias("trip_count"),
            steady_round(mean_surge(), 2).alias("avg_surge"),
            F.round(F.max("surge_multiplier"), 2).alias("max_surge"),
            steady_round(mean_of("speed"), 1).alias("avg_speed_mph"),
        )
        .orderBy(F.desc("avg_surge"), "hour", "day_of_week")
        .limit(top)
    )
