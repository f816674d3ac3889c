"""The given `events` table read as trips, request messages and predictions.

The mappings are row by row, so every query's work grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefare.operators.sampling import train_test_split
from tidefare.operators.trips import labelled_trips
from tidefare.schemas import RIDE_REQUEST

ZONES = {"click": "Downtown", "view": "Uptown", "purchase": "Suburbs", "signup": "Industrial"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a glob, the path may be one file or a folder of files.
    stored = events(spark, sf_dir).schema
    return spark.readStream.schema(stored).parquet(f"{sf_dir}/{{events}}.parquet")


def _with_k(rows: DataFrame) -> DataFrame:
    """Add the integer `k` of `props`; as a generator's output it is read once per row."""
    number = F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).try_cast("int")
    return rows.select("*", F.explode(F.array(number)).alias("k"))


def _longitude(shift: int) -> str:
    return f"(-74050 + 10 * ((user_id + {shift}) % 10) + (k + {shift}) % 4) / 1000D"


def _latitude(shift: int) -> str:
    return f"(40700 + 10 * ((k + {shift}) % 8) + (user_id + {shift}) % 4) / 1000D"


def trips_from_events(rows: DataFrame) -> DataFrame:
    """Raw trips: `trip_id`, times, measures, passengers and coordinates, some of them unusable."""
    seconds = "if(event_id % 97 = 0, 12000, cast(20 + (event_id * 37) % 6000 AS int))"
    return _with_k(rows).selectExpr(
        "event_id AS trip_id",
        "cast(ts AS timestamp) AS pickup_dt",
        f"timestampadd(SECOND, {seconds}, cast(ts AS timestamp)) AS dropoff_dt",
        "if(event_id % 89 = 0, 150D, k / 5D) AS trip_distance",
        "if(event_id % 53 = 0, -value, value) AS fare_amount",
        "cast(user_id % 7 AS int) AS passenger_count",
        f"if(event_id % 61 != 0, {_longitude(0)}, null) AS pickup_longitude",
        f"if(event_id % 67 != 0, {_latitude(0)}, null) AS pickup_latitude",
        f"if(event_id % 71 != 0, {_longitude(3)}, null) AS dropoff_longitude",
        f"if(event_id % 71 != 0, {_latitude(3)}, null) AS dropoff_latitude",
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(events(spark, sf_dir))


def exported(trips: DataFrame) -> DataFrame:
    """Trips under the exported names, with times as text to the microsecond."""
    return trips.select(
        F.col("pickup_dt").cast("string").alias("tpep_pickup_datetime"),
        F.col("dropoff_dt").cast("string").alias("tpep_dropoff_datetime"),
        "trip_id", "trip_distance", "fare_amount", "passenger_count",
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    )


def raw_trips_as_exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exported(raw_trips(spark, sf_dir))


def clean_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_trips(raw_trips(spark, sf_dir))


def messages_from_events(rows: DataFrame, **changed: str) -> DataFrame:
    """Request messages as JSON text in `value`; fields without a value are left out. `changed` replaces expressions."""
    zone = " ".join(f"WHEN '{event_type}' THEN '{name}'" for event_type, name in ZONES.items())
    fields = {
        "timestamp": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
        "zone": f"CASE event_type {zone} END",
        "ride_requests": "2 * k",
        "available_drivers": "cast(5 + user_id % 76 AS int)",
        "hour": "hour(ts)",
        "is_weekend": "weekday(ts) >= 5",
        "weather_code": "cast(event_id % 4 AS int)",
        "special_event": "if(event_id % 5 != 0, k % 10 = 0, null)",
        "weather": "cast(null AS string)",
        "event_id": "cast(event_id AS string)",
    }
    fields |= changed
    body = F.struct(*[F.expr(fields[name]).alias(name) for name in RIDE_REQUEST.fieldNames()])
    return _with_k(rows).select("event_id", F.to_json(body).alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(events(spark, sf_dir)).select("value")


def messages_with_bad_ones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `messages`, with every 83rd message replaced by text that is not JSON."""
    return messages_from_events(events(spark, sf_dir)).selectExpr(
        "if(event_id % 83 = 0, concat('bad ', event_id), value) AS value"
    )


def messages_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without an id, timed to the minute, every 997th in the year 9999."""
    minute = "date_format(date_trunc('minute', ts), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    late = f"if(event_id % 997 = 0, '9999-06-01T12:00:00.000000', {minute})"
    return messages_from_events(events(spark, sf_dir), timestamp=late, event_id="cast(null AS string)").select("value")


def mixed(rows: DataFrame) -> DataFrame:
    """Messages of which every 83rd is no JSON, and every 41st of the others has no time."""
    timed = "if(event_id % 41 != 0, date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), null)"
    return messages_from_events(rows, timestamp=timed).selectExpr("if(event_id % 83 = 0, concat('bad ', event_id), value) AS value")


def _in_slots(rows: DataFrame, slots: int) -> list[DataFrame]:
    """The rows in slots of time of equal length, the earliest first."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = rows.select(F.min(micros), F.max(micros)).first()
    part = F.least(F.floor((micros - first) * slots / F.lit(last - first + 1)), F.lit(slots - 1))
    return [rows.where(part == number) for number in range(slots)]


def _arrives(rows: DataFrame, path: str) -> None:
    """Adds the messages to the feed, in as many text files as the rows have parts, so that no task writes a whole slot."""
    messages_from_events(rows).select("value").write.mode("append").text(path)


def feed_in_order(spark: SparkSession, sf_dir: str, path: str, slots: int = 6) -> Iterator[None]:
    """Writes the messages as text files, a slot of time at each step, the earliest first."""
    for slot in _in_slots(events(spark, sf_dir), slots):
        yield _arrives(slot, path)


def feed_with_old_rows(spark: SparkSession, sf_dir: str, path: str) -> Iterator[None]:
    """The feed in order, and a last step in which every fiftieth message comes again, as one more request of its old time."""
    yield from feed_in_order(spark, sf_dir, path)
    again = events(spark, sf_dir).where("event_id % 50 = 0")
    yield messages_from_events(again, event_id="concat('again ', event_id)").select("value").write.mode("append").text(path)


def feed_with_replays(spark: SparkSession, sf_dir: str, path: str, slots: int = 6) -> Iterator[None]:
    """The feed in order, each message twice in its slot and once more in the next one."""
    before = None
    for slot in _in_slots(events(spark, sf_dir), slots):
        own = slot.unionByName(slot)
        yield _arrives(own if before is None else own.unionByName(before), path)
        before = slot


def requests_of_users(rows: DataFrame) -> DataFrame:
    """user_id, event_time, zone and ride_requests of each event."""
    zone = " ".join(f"WHEN '{event_type}' THEN '{name}'" for event_type, name in ZONES.items())
    return _with_k(rows).selectExpr("user_id", "cast(ts AS timestamp) AS event_time", f"CASE event_type {zone} END AS zone", "2 * k AS ride_requests")


def user_feed_in_order(spark: SparkSession, sf_dir: str, path: str, slots: int = 6) -> Iterator[None]:
    """Writes `requests_of_users` as files, a slot of time at each step, the earliest first."""
    for slot in _in_slots(events(spark, sf_dir), slots):
        yield requests_of_users(slot).write.mode("append").parquet(path)


def user_feed(spark: SparkSession, path: str) -> DataFrame:
    """What `user_feed_in_order` wrote, as a stream."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def zoned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip_id, zone and pickup_dt of every event, the pickup half a minute after it; every 29th has no zone."""
    zone = " ".join(f"WHEN '{event_type}' THEN '{name}'" for event_type, name in ZONES.items())
    return events(spark, sf_dir).selectExpr(
        "event_id AS trip_id", f"if(event_id % 29 != 0, CASE event_type {zone} END, null) AS zone", "timestampadd(SECOND, 30, cast(ts AS timestamp)) AS pickup_dt",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-part trips with a prediction that misses the label by a known amount, up to 0.1."""
    _, test = train_test_split(clean_labelled(spark, sf_dir), "trip_id")
    return test.selectExpr(
        "trip_id",
        "surge_multiplier AS label",
        "surge_multiplier + ((trip_id * 31) % 21 - 10) / 100D AS prediction",
        "hour", "day_of_week", "is_weekend",
    )
