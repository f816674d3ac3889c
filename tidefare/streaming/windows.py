"""Demand, supply and surge per zone and time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefare.functions import surge

WINDOW = "5 minutes"
LATENESS = "2 minutes"


def _arrival_order() -> Column:
    """Event time, then a code of the carried values, as one number.

    A struct would be the plain choice, but only fixed-width buffers let Spark aggregate by
    hash; with a struct every task sorts all its rows first. Messages of one instant are ordered
    by weather code, then weekend, nulls first, so equal numbers carry equal values.
    """
    weather = F.coalesce(F.col("weather_code").cast("long") + F.lit((1 << 31) + 1), F.lit(0))
    weekend = F.coalesce(F.col("is_weekend").cast("int") + 1, F.lit(0))
    micros = F.unix_micros("event_time").cast("decimal(20,0)")
    shifted = (micros * F.lit(1 << 40).cast("decimal(13,0)")).cast("decimal(37,0)")
    return (shifted + (weather * 4 + weekend).cast("decimal(20,0)")).cast("decimal(38,0)")


def demand_windows(requests: DataFrame, width: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Total requests and mean drivers per tumbling window and zone.

    Each task combines its own rows before the shuffle, so a busy zone sends one row per task
    and window. Weather and weekend come from the earliest request of the window. Windows
    older than the watermark leave the state; rows for them are dropped.
    """
    return (
        requests.withWatermark("event_time", lateness)
        .withColumn("arrival", _arrival_order())
        .groupBy(F.window("event_time", width).alias("window"), "zone")
        .agg(
            F.sum("ride_requests").alias("total_requests"),
            F.avg("available_drivers").alias("avg_drivers"),
            F.min_by("weather_code", "arrival").alias("weather_code"),
            F.min_by("is_weekend", "arrival").alias("is_weekend"),
        )
    )


def priced_windows(windows: DataFrame, *others: str) -> DataFrame:
    """Add the demand/supply ratio and the window's surge; flatten the bounds. Keeps the columns `others`."""
    ratio = surge.window_ratio(F.col("total_requests"), F.col("avg_drivers"))
    return windows.withColumn("demand_supply_ratio", ratio).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "zone", "total_requests", "avg_drivers", "weather_code", "is_weekend",
        "demand_supply_ratio",
        surge.window_surge(F.col("demand_supply_ratio")).alias("surge_multiplier"),
        *others,
    )


def window_surge(requests: DataFrame, width: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    return priced_windows(demand_windows(requests, width, lateness))
