"""Small tables from driver-side values."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rows_of(spark: SparkSession, schema: str, rows: list[dict]) -> DataFrame:
    """A few known rows as a DataFrame, without starting Python workers for them."""
    values = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(values))
