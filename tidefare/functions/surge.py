"""Surge rules, kept as data and turned into Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The surge rules.
# (first hour, last hour, is_weekend, multiplier), first match wins, before any other trip rule.
PEAK_RULES = (
    (7, 9, 0, 2.5),
    (17, 19, 0, 2.8),
    (22, 23, 1, 3.2),
    (0, 2, 1, 3.0),
)
# (speed below, multiplier)
SLOW_RULES = ((5, 2.0), (10, 1.6))
# (passengers above, multiplier)
CROWD_RULE = (4, 1.4)
# The levels a trip can have.
TRIP_LEVELS = (1.0, 1.4, 1.6, 2.0, 2.5, 2.8, 3.0, 3.2)
# (ratio from, multiplier) for a window of demand and for one request message.
WINDOW_LADDER = ((1.0, 1.4), (1.3, 1.8), (1.8, 2.2), (2.5, 2.8), (3.5, 3.5))
EVENT_LADDER = ((1.0, 1.2), (1.3, 1.4), (1.8, 1.8), (2.5, 2.2), (3.5, 2.8), (5.0, 3.5))
# (weather code from, premium)
WEATHER_LADDER = ((2, 0.3), (3, 0.5))
SPECIAL_EVENT_PREMIUM = 0.5
WEEKEND_PREMIUM = 0.3
SURGE_CAP = 5.0
BASE_FARE_USD = 2.50
DEFAULT_REQUESTS = 50
DEFAULT_DRIVERS = 20
# (value from, band)
SURGE_BANDS = ((1.5, "mid"), (2.5, "high"))
IMPORTANCE_BANDS = ((0.05, "medium"), (0.15, "high"))

Steps = Sequence[tuple[float, float | str]]


def ladder(value: Column, steps: Steps, floor: float | str) -> Column:
    """Result of the highest step that `value` reaches; `floor` below all steps and for null."""
    reached = [F.when(value >= start, F.lit(result)) for start, result in sorted(steps, reverse=True)]
    return F.coalesce(*reached, F.lit(floor))


def trip_surge(hour: Column, is_weekend: Column, speed: Column, passengers: Column) -> Column:
    """Multiplier of one trip. A null operand makes its rule miss; no rule gives 1.0."""
    peaks = [
        F.when(hour.between(first, last) & (is_weekend == weekend), F.lit(multiplier))
        for first, last, weekend, multiplier in PEAK_RULES
    ]
    slow = [F.when(speed < limit, F.lit(multiplier)) for limit, multiplier in SLOW_RULES]
    crowd_limit, crowd_multiplier = CROWD_RULE
    crowd = F.when(passengers > crowd_limit, F.lit(crowd_multiplier))
    return F.coalesce(*peaks, *slow, crowd, F.lit(1.0))


def window_ratio(total_requests: Column, avg_drivers: Column) -> Column:
    """Requests per average driver to 2 decimals; null without drivers."""
    return F.round(F.try_divide(total_requests, avg_drivers), 2)


def window_surge(ratio: Column, steps: Steps = WINDOW_LADDER) -> Column:
    return ladder(ratio, steps, 1.0)


def event_ratio(requests: Column, drivers: Column) -> Column:
    """Requests per driver of one message, with the feed's defaults for missing fields."""
    demand = F.coalesce(requests, F.lit(DEFAULT_REQUESTS)).cast("double")
    return demand / F.greatest(F.coalesce(drivers, F.lit(DEFAULT_DRIVERS)), F.lit(1))


def event_surge(
    requests: Column,
    drivers: Column,
    weather_code: Column,
    special_event: Column,
    is_weekend: Column,
    steps: Steps = EVENT_LADDER,
) -> Column:
    """Capped multiplier of one message: demand ladder plus weather, event and weekend premiums."""
    total = (
        ladder(event_ratio(requests, drivers), steps, 1.0)
        + ladder(weather_code, WEATHER_LADDER, 0.0)
        + F.when(special_event, F.lit(SPECIAL_EVENT_PREMIUM)).otherwise(F.lit(0.0))
        + F.when(is_weekend, F.lit(WEEKEND_PREMIUM)).otherwise(F.lit(0.0))
    )
    return F.round(F.least(total, F.lit(SURGE_CAP)), 2)


def surge_band(surge: Column) -> Column:
    return ladder(surge, SURGE_BANDS, "low")


def importance_band(importance: Column) -> Column:
    return ladder(importance, IMPORTANCE_BANDS, "low")
