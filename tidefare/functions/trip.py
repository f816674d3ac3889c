"""Trip measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    """Whole seconds between two times, in minutes to 2 decimals.

    A hundredth of a minute is 0.6 s, so whole seconds never fall halfway between two
    hundredths, and one floor of a division by 6 rounds exactly, without decimals.
    """
    seconds = F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)
    return F.floor((seconds * 10 + 3) / F.lit(6)) / F.lit(100.0)


def average_speed(distance: Column, minutes: Column) -> Column:
    """Miles per hour to 2 decimals; 0 unless the duration is positive."""
    return F.when(minutes > 0, F.round(distance / (minutes / F.lit(60)), 2)).otherwise(F.lit(0.0))


def grid(coordinate: Column) -> Column:
    """Edge of the 0.01-degree cell that holds a coordinate."""
    return F.round(coordinate, 2)


def nan_to_null(value: Column) -> Column:
    """NaN compares above every number in Spark, so a NaN measure would pass a `> 0` filter."""
    return F.nanvl(value, F.lit(None).cast("double"))
