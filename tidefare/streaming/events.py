"""Surge and fare of single request messages; map-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefare.functions import surge
from tidefare.schemas import PRICED_EVENT

ISO_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def price_events(requests: DataFrame, processed_at: Column | None = None, *others: str) -> DataFrame:
    """The published fields of each request, with defaults for what it leaves out, and the columns `others`.

    `ride_requests` and `available_drivers` are passed through as they came.
    """
    clock = F.current_timestamp() if processed_at is None else processed_at
    multiplier = surge.event_surge(
        F.col("ride_requests"), F.col("available_drivers"), F.col("weather_code"),
        F.col("special_event"), F.col("is_weekend"),
    )
    return requests.withColumn("surge_multiplier", multiplier).select(
        F.date_format(clock, ISO_MICROSECONDS).alias("timestamp"),
        F.coalesce("zone", F.lit("Unknown")).alias("zone"),
        "surge_multiplier",
        "ride_requests",
        "available_drivers",
        F.coalesce("weather", F.lit("clear")).alias("weather"),
        F.coalesce("special_event", F.lit(False)).alias("special_event"),
        F.lit(surge.BASE_FARE_USD).alias("base_fare_usd"),
        F.round(F.col("surge_multiplier") * surge.BASE_FARE_USD, 2).alias("effective_fare_usd"),
        F.coalesce("event_id", F.lit("")).alias("source_event_id"),
        *others,
    )


def as_messages(priced: DataFrame) -> DataFrame:
    """Priced events as (key, value): the zone and a JSON object that keeps null fields."""
    body = F.to_json(F.struct(*PRICED_EVENT.fieldNames()), {"ignoreNullFields": "false"})
    return priced.select(F.col("zone").alias("key"), body.alias("value"))
