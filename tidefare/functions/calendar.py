"""Calendar features and peak-period flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names in Monday-first order.
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

# Inclusive hour ranges of the model's period flags.
FLAG_HOURS = {
    "is_morning_peak": ((7, 9),),
    "is_evening_peak": ((17, 20),),
    "is_late_night": ((22, 23), (0, 2)),
}


def weekend_flag(ts: Column) -> Column:
    """1 on Saturday and Sunday, else 0; null for a null time."""
    return (F.weekday(ts) >= 5).cast("int")


def day_name(dow_monday: Column) -> Column:
    """Name of a 0 = Monday day number; null outside 0..6."""
    return F.get(F.array(*[F.lit(name) for name in DAY_NAMES]), dow_monday)


def day_number(name: Column) -> Column:
    """0 = Monday number of a day name; null for any other text."""
    position = F.array_position(F.array(*[F.lit(day) for day in DAY_NAMES]), name)
    return F.nullif(position, F.lit(0)).cast("int") - 1


def monday_first(day_of_week: Column) -> Column:
    """0 = Monday number from a 1 = Sunday number."""
    return F.pmod(day_of_week + F.lit(5), F.lit(7)).cast("int")


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend == 1, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def period_flag(hour: Column, name: str) -> Column:
    """0/1 flag for one of `FLAG_HOURS`; a null hour gives 0."""
    inside = F.lit(False)
    for first, last in FLAG_HOURS[name]:
        inside = inside | hour.between(first, last)
    return F.coalesce(inside.cast("int"), F.lit(0))
