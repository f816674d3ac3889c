"""Schemas of everything the library reads or writes."""

from pyspark.sql import types as T

# Columns of the raw trip table.
TRIP_TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
TRIP_MEASURES = ("trip_distance", "fare_amount")
TRIP_COORDINATES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")

# Columns of the stored feature table, in order.
FEATURE_COLUMNS = (
    "hour", "day_of_week", "month", "is_weekend",
    "trip_distance", "passenger_count", "trip_duration_min", "avg_speed_mph",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "fare_amount", "surge_multiplier",
)

FEATURES = T.StructType([
    T.StructField(
        name,
        T.IntegerType()
        if name in ("hour", "day_of_week", "month", "is_weekend", "passenger_count")
        else T.DoubleType(),
    )
    for name in FEATURE_COLUMNS
])

# One ride-request message. The last three fields are optional in the feed.
RIDE_REQUEST = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("ride_requests", T.IntegerType()),
    T.StructField("available_drivers", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("weather_code", T.IntegerType()),
    T.StructField("special_event", T.BooleanType()),
    T.StructField("weather", T.StringType()),
    T.StructField("event_id", T.StringType()),
])

# One priced event, as published.
PRICED_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("surge_multiplier", T.DoubleType()),
    T.StructField("ride_requests", T.IntegerType()),
    T.StructField("available_drivers", T.IntegerType()),
    T.StructField("weather", T.StringType()),
    T.StructField("special_event", T.BooleanType()),
    T.StructField("base_fare_usd", T.DoubleType()),
    T.StructField("effective_fare_usd", T.DoubleType()),
    T.StructField("source_event_id", T.StringType()),
])

# One stored prediction.
PREDICTIONS = T.StructType([
    T.StructField("label", T.DoubleType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
])
