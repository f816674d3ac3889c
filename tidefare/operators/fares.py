"""Fare against distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefare.operators.sampling import DEFAULT_SEED, seeded_sample

# The range of the fare plot.
MAX_FARE = 60
MAX_DISTANCE = 20


def plot_range(trips: DataFrame) -> DataFrame:
    """Drop the fares and distances that the fare plot leaves out."""
    return trips.filter((F.col("fare_amount") < MAX_FARE) & (F.col("trip_distance") < MAX_DISTANCE))


def fare_scatter(trips: DataFrame, *keys: str, n: int = 5000, seed: int = DEFAULT_SEED) -> DataFrame:
    """Points of the fare plot: a seeded sample, then the plot range."""
    points = plot_range(seeded_sample(trips, n, *keys, seed=seed))
    return points.select(*keys, "trip_distance", "fare_amount", "surge_multiplier")


def fare_trend(points: DataFrame) -> DataFrame:
    """Least-squares line of fare on distance."""
    return points.agg(
        F.regr_slope("fare_amount", "trip_distance").alias("slope"),
        F.regr_intercept("fare_amount", "trip_distance").alias("intercept"),
        F.regr_count("fare_amount", "trip_distance").alias("points"),
    )


def trend_line(trend: DataFrame, last: float = MAX_DISTANCE, points: int = 100) -> DataFrame:
    """Evenly spaced points of a fitted line from distance 0 to `last`."""
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    return (
        trend.select("slope", "intercept", step.alias("step"))
        .withColumn("trip_distance", F.col("step") * F.lit(float(last)) / F.lit(points - 1))
        .withColumn("fare_amount", F.col("slope") * F.col("trip_distance") + F.col("intercept"))
        .select("step", "trip_distance", "fare_amount")
    )
