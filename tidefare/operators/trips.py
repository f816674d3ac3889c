"""From raw trips to labelled, cleaned trips."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefare.functions import calendar, surge, trip
from tidefare.operators.local import rows_of
from tidefare.schemas import FEATURE_COLUMNS


def with_features(trips: DataFrame) -> DataFrame:
    """Add calendar features, duration and speed to trips with `pickup_dt` and `dropoff_dt`.

    Speed uses the rounded duration.
    """
    pickup = F.col("pickup_dt")
    derived = F.struct(
        F.hour(pickup).alias("hour"),
        F.dayofweek(pickup).alias("day_of_week"),
        F.month(pickup).alias("month"),
        calendar.weekend_flag(pickup).alias("is_weekend"),
        trip.duration_minutes(pickup, F.col("dropoff_dt")).alias("trip_duration_min"),
    )
    speed = trip.average_speed(F.col("trip_distance"), F.col("trip_duration_min"))
    # As a generator's output the features are computed once per trip. As plain columns they,
    # and all the parsing below them, would be copied into each filter above, into methods
    # too long for the JVM to compile. Filters on stored columns still reach the scan.
    return trips.select("*", F.inline(F.array(derived))).select(
        "*", F.explode(F.array(speed)).alias("avg_speed_mph")
    )


def with_surge(trips: DataFrame) -> DataFrame:
    """Add the rule-based `surge_multiplier`."""
    return trips.withColumn(
        "surge_multiplier",
        surge.trip_surge(
            F.col("hour"), F.col("is_weekend"), F.col("avg_speed_mph"), F.col("passenger_count")
        ),
    )


def cleaning_rules() -> dict[str, Column]:
    """The conditions a usable trip meets, by name. Null never passes.

    The rules on stored columns come first; they reach the Parquet scan as pushed filters.
    """
    return {
        "distance": F.col("trip_distance").between(0.1, 100.0),
        "fare": F.col("fare_amount") > 0,
        "passengers": F.col("passenger_count") > 0,
        "longitude": F.col("pickup_longitude").isNotNull(),
        "latitude": F.col("pickup_latitude").isNotNull(),
        "duration": F.col("trip_duration_min").between(1.0, 180.0),
        "speed": F.col("avg_speed_mph") < 120,
    }


def clean(trips: DataFrame) -> DataFrame:
    """Keep the trips that meet every cleaning rule."""
    return trips.filter(reduce(and_, cleaning_rules().values()))


def labelled_trips(trips: DataFrame) -> DataFrame:
    """Raw trips to cleaned trips with features and surge."""
    return clean(with_surge(with_features(trips)))


def feature_table(trips: DataFrame, *extra: str) -> DataFrame:
    """The stored feature columns, after any extra key columns."""
    return trips.select(*extra, *FEATURE_COLUMNS)


def with_period_flags(trips: DataFrame) -> DataFrame:
    """Add the morning-peak, evening-peak and late-night flags."""
    return trips.withColumns({
        name: calendar.period_flag(F.col("hour"), name) for name in calendar.FLAG_HOURS
    })


def with_day_names(trips: DataFrame) -> DataFrame:
    """Add the 0 = Monday day number, the day name and the day type."""
    return trips.withColumn(
        "dow_monday", calendar.monday_first(F.col("day_of_week"))
    ).withColumns({
        "day_name": calendar.day_name(F.col("dow_monday")),
        "day_type": calendar.day_type(F.col("is_weekend")),
    })


def clean_audit(trips: DataFrame, in_train: Column | None = None) -> DataFrame:
    """Raw, clean and per-rule rejected counts in one pass; train and test counts if a split is given."""
    met = {name: F.coalesce(rule, F.lit(False)) for name, rule in cleaning_rules().items()}
    passed = reduce(and_, met.values())
    counts = {"raw_rows": F.count(F.lit(1)), "clean_rows": F.count_if(passed)}
    for name, rule in met.items():
        counts[f"rejected_{name}"] = F.count_if(~rule)
    if in_train is not None:
        counts["train_rows"] = F.count_if(passed & in_train)
        counts["test_rows"] = F.count_if(passed & ~in_train)
    return trips.agg(*[value.alias(name) for name, value in counts.items()])


def column_report(frame: DataFrame) -> DataFrame:
    """Position, name and type of each column, with the table's rows and the column's nulls as counted in one pass."""
    fields = frame.schema.fields
    counted = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{field.name}`").isNull()).alias(f"nulls_{position}") for position, field in enumerate(fields)],
    )
    return counted.select(F.inline(F.array(*[
        F.struct(
            F.lit(position).alias("position"), F.lit(field.name).alias("name"), F.lit(field.dataType.simpleString()).alias("type"),
            F.col("rows"), F.col(f"nulls_{position}").alias("nulls"),
        )
        for position, field in enumerate(fields)
    ])))


def schema_report(frame: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column; reads no data."""
    return rows_of(
        frame.sparkSession,
        "position: int, name: string, type: string, nullable: boolean",
        [
            {
                "position": position,
                "name": field.name,
                "type": field.dataType.simpleString(),
                "nullable": field.nullable,
            }
            for position, field in enumerate(frame.schema.fields)
        ],
    )
