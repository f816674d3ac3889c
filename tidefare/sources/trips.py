"""Trip tables from CSV or Parquet, and stored features."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidefare.functions.trip import nan_to_null
from tidefare.schemas import FEATURE_COLUMNS, TRIP_COORDINATES, TRIP_MEASURES, TRIP_TIMES


def typed_trips(raw: DataFrame, *keys: str) -> DataFrame:
    """The trip columns of a raw table with fixed types, chosen by name.

    Text that does not parse, and NaN, become null instead of failing the job. Any key
    columns are kept as they are.
    """
    numbers = [
        nan_to_null(F.col(name).try_cast("double")).alias(name)
        for name in (*TRIP_MEASURES, *TRIP_COORDINATES)
    ]
    # Later exports write passenger counts as "1.0", which does not parse as an integer.
    passengers = nan_to_null(F.col("passenger_count").try_cast("double")).try_cast("int")
    pickup, dropoff = (F.col(name).try_cast("timestamp") for name in TRIP_TIMES)
    return raw.select(
        *keys,
        pickup.alias("pickup_dt"),
        dropoff.alias("dropoff_dt"),
        *numbers,
        passengers.alias("passenger_count"),
    )


def read_trips_csv(spark: SparkSession, path: str | list[str], *keys: str) -> DataFrame:
    """Trips from CSV with a header.

    Only the header line is read to find the columns, there is no type-inference pass, and
    columns that are not used are not parsed. A file whose header differs from the first
    file's fails the job rather than shifting columns.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return typed_trips(raw, *keys)


def read_trips_parquet(spark: SparkSession, path: str | list[str], *keys: str) -> DataFrame:
    return typed_trips(spark.read.parquet(path), *keys)


def read_features(spark: SparkSession, path: str, *extra: str) -> DataFrame:
    """Stored features; column choice and filters reach the Parquet scan."""
    return spark.read.parquet(path).select(*extra, *FEATURE_COLUMNS)


def read_trips_csv_in_order(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trips from CSV with the file and the part of it (`source_file`, `source_start`) each row came from.

    A CSV scan cannot number its rows, but a task reads a part in order, and so stores it.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    named = raw.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "source_start": F.col("_metadata.file_block_start"),
    })
    return typed_trips(named, "source_file", "source_start")


def read_positioned(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet copy of `read_trips_csv_in_order` with each row's `position` in the CSV files.

    Files count in order of their names, so positions do not depend on how the table is divided
    into files or how tasks wrote the copy: a task may store a part in several files, which it numbers.
    The running sum covers one row for each stored file of each part that a task read.
    """
    copy = spark.read.parquet(path).withColumns({
        "stored_row": F.col("_metadata.row_index"),
        "stored_file": F.regexp_extract("_metadata.file_name", r"[.-]c(\d+)[.]", 1).try_cast("int"),
    })
    keys = ["source_file", "source_start", "stored_file"]
    parts = copy.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min("stored_row").alias("first_row"))
    before = W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        *(F.col(name).alias(f"of_{name}") for name in keys),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first_row")).alias("offset"),
    )
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in keys))
    return (
        copy.join(offsets, same)
        .withColumn("position", F.col("offset") + F.col("stored_row"))
        .drop(*keys, *(f"of_{name}" for name in keys), "stored_row", "offset")
    )
