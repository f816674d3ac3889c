"""Prediction files and tables that are built once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefare.schemas import PREDICTIONS


#: Tells rows of a predictions file apart, also equal ones.
ROW_KEY = "row_key"


def read_predictions_csv(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame:
    """Predictions written by `write_predictions_csv`; `keyed` adds their `row_key`.

    Columns are chosen by the header's names. Files from elsewhere have no key; their rows then
    share the empty key of equal values.
    """
    stored = spark.read.option("header", True).csv(path)
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in PREDICTIONS.fields]
    if keyed:
        own = F.col(ROW_KEY) if ROW_KEY in stored.columns else F.md5(F.to_json(F.struct(*PREDICTIONS.fieldNames())))
        columns.append(own.alias(ROW_KEY))
    return stored.select(*columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote `path` finished; a half-written folder has no success marker."""
    return path_exists(spark, f"{path}/_SUCCESS")


def cached_table(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet table at `path`; built and written first if it is not complete."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
