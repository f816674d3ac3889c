"""Ride-request feeds. Every reader gives one string column, `value`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REQUEST_TOPIC = "ride_requests"


def kafka_options(
    servers: str,
    topic: str = REQUEST_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Settings of the Kafka source. Offsets live in the query's checkpoint, not in a consumer group."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, servers: str, **settings) -> DataFrame:
    """Messages from Kafka; needs the Kafka connector on the session's classpath."""
    source = spark.readStream.format("kafka").options(**kafka_options(servers, **settings)).load()
    return source.selectExpr("CAST(value AS STRING) AS value")


def read_json_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages from files of JSON lines, as a stream."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("value")
