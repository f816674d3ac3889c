"""Datasets behind the dashboard.

Every dataset but the row-level ones is computed from trip cells (see `cells`), and so are
all filters, because each filter tests a cell key. With stored cells only the preview and the
fare points scan the trips.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidefare.functions import calendar, surge
from tidefare.operators.cells import mean_of, mean_surge, surge_level_trips
from tidefare.operators.sampling import DEFAULT_SEED, seeded_sample

HOURS = range(24)
# Columns of the preview, in order.
PREVIEW_COLUMNS = (
    "hour", "day_name", "is_weekend", "trip_distance", "fare_amount",
    "passenger_count", "avg_speed_mph", "trip_duration_min", "surge_multiplier",
)


@dataclass(frozen=True)
class FilterSpec:
    """What the viewer selected; the defaults select everything."""

    days: Sequence[str] = calendar.DAY_NAMES
    first_hour: int = 0
    last_hour: int = 23
    surge_levels: Sequence[float] | None = None
    day_type: str = "All"

    def condition(self) -> Column:
        day_numbers = [number for number, name in enumerate(calendar.DAY_NAMES) if name in self.days]
        keep = F.col("dow_monday").isin(day_numbers)
        keep = keep & F.col("hour").between(self.first_hour, self.last_hour)
        if self.surge_levels is not None:
            keep = keep & F.col("surge_multiplier").isin(list(self.surge_levels))
        if self.day_type == "Weekday Only":
            keep = keep & (F.col("is_weekend") == 0)
        elif self.day_type == "Weekend Only":
            keep = keep & (F.col("is_weekend") == 1)
        elif self.day_type != "All":
            raise ValueError(f"unknown day type: {self.day_type}")
        return keep


def apply_filter(rows: DataFrame, spec: FilterSpec) -> DataFrame:
    """Filter trips (with `dow_monday`) or cells."""
    return rows.filter(spec.condition())


def has_rows(rows: DataFrame) -> bool:
    """Whether a filter left anything; stops at the first row."""
    return not rows.isEmpty()


def kpis(cells: DataFrame) -> DataFrame:
    """Mean and peak surge, trips, mean fare and mean distance, as one row."""
    return cells.agg(
        mean_surge().alias("avg_surge"),
        F.max("surge_multiplier").alias("max_surge"),
        F.coalesce(F.sum("trips"), F.lit(0)).alias("total_trips"),
        mean_of("fare").alias("avg_fare"),
        mean_of("distance").alias("avg_distance"),
    )


def hourly_surge(cells: DataFrame) -> DataFrame:
    """Mean surge and its band for each hour that has trips."""
    return (
        cells.groupBy("hour")
        .agg(mean_surge().alias("avg_surge"))
        .withColumn("band", surge.surge_band(F.col("avg_surge")))
        .orderBy("hour")
    )


def hourly_surge_dense(cells: DataFrame) -> DataFrame:
    """As `hourly_surge`, with a row for each of the 24 hours."""
    hours = cells.sparkSession.range(0, 24, 1, 1).select(F.col("id").cast("int").alias("hour"))
    means = cells.groupBy("hour").agg(mean_surge().alias("avg_surge"))
    return (
        hours.join(means, "hour", "left")
        .withColumn("band", surge.surge_band(F.col("avg_surge")))
        .orderBy("hour")
    )


def surge_box_by_day(cells: DataFrame) -> DataFrame:
    """Box-plot figures per day: quartiles, whiskers within 1.5 IQR, and outliers beyond them.

    Exact: the percentiles weigh each level by its trips. A day has at most 8 level rows.
    """
    levels = surge_level_trips(cells, "dow_monday")
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = levels.withColumn(
        "q",
        F.percentile("surge_multiplier", quarters, F.col("trips")).over(W.partitionBy("dow_monday")),
    ).withColumns({"q1": F.col("q")[0], "median": F.col("q")[1], "q3": F.col("q")[2]})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    # Rounded, so that a level on a fence is inside whatever the last bit says.
    low_fence, high_fence = F.round(F.col("q1") - reach, 9), F.round(F.col("q3") + reach, 9)
    level = F.col("surge_multiplier")
    inside = level.between(low_fence, high_fence)
    return (
        quartiles.groupBy("dow_monday", "q1", "median", "q3")
        .agg(
            F.min(F.when(level >= low_fence, level)).alias("low"),
            F.max(F.when(level <= high_fence, level)).alias("high"),
            F.sum("trips").alias("trips"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("trips"))).alias("outliers"),
        )
        .select(
            "dow_monday",
            calendar.day_name(F.col("dow_monday")).alias("day_name"),
            "q1", "median", "q3",
            # A whisker never ends inside the box.
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
            "trips", "outliers",
        )
        .orderBy("dow_monday")
    )


def surge_share(cells: DataFrame) -> DataFrame:
    """Trips and percentage for each surge level."""
    levels = surge_level_trips(cells)
    # The unpartitioned frame covers one row per level.
    total = F.sum("trips").over(W.partitionBy())
    return levels.withColumn("share_pct", F.col("trips") * 100.0 / total).orderBy("surge_multiplier")


def surge_levels(cells: DataFrame) -> DataFrame:
    """The surge levels present, in order."""
    return cells.select("surge_multiplier").distinct().orderBy("surge_multiplier")


def surge_heatmap(cells: DataFrame) -> DataFrame:
    """Mean surge per (day, hour) that has trips."""
    return (
        cells.groupBy("dow_monday", "hour")
        .agg(mean_surge().alias("avg_surge"))
        .withColumn("day_name", calendar.day_name(F.col("dow_monday")))
        .orderBy("dow_monday", "hour")
    )


def surge_heatmap_pivot(cells: DataFrame, all_days: bool = True) -> DataFrame:
    """Mean surge with one row per day and one column per hour (`h00` to `h23`).

    With `all_days`, a day without trips has a row of nulls; otherwise it is left out.
    """
    pivoted = (
        cells.groupBy("dow_monday")
        .pivot("hour", list(HOURS))
        .agg(mean_surge())
        .toDF("dow_monday", *[f"h{hour:02d}" for hour in HOURS])
    )
    if all_days:
        days = cells.sparkSession.range(0, 7, 1, 1).select(F.col("id").cast("int").alias("dow_monday"))
        pivoted = days.join(pivoted, "dow_monday", "left")
    return pivoted.withColumn("day_name", calendar.day_name(F.col("dow_monday"))).orderBy("dow_monday")


def weekday_weekend_hourly(cells: DataFrame) -> DataFrame:
    """Hourly mean surge of weekdays and of weekends."""
    return (
        cells.groupBy("is_weekend", "hour")
        .agg(mean_surge().alias("avg_surge"))
        .withColumn("day_type", calendar.day_type(F.col("is_weekend")))
        .orderBy("is_weekend", "hour")
    )


def trip_preview(trips: DataFrame, *keys: str, n: int = 500, seed: int = DEFAULT_SEED) -> DataFrame:
    """A seeded sample of named trips, highest surge first, then in key order."""
    picked = seeded_sample(trips, n, *keys, seed=seed)
    return picked.orderBy(F.desc("surge_multiplier"), *keys).select(*keys, *PREVIEW_COLUMNS)
