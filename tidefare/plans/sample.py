"""Sample job: CSV trips to a stored sample of labelled trips, built once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidefare.operators.sampling import block_sample
from tidefare.operators.trips import feature_table, labelled_trips
from tidefare.sources.tables import cached_table
from tidefare.sources.trips import read_positioned, read_trips_csv_in_order


def stored_sample(
    spark: SparkSession,
    csv_path: str,
    trips_path: str,
    sample_path: str,
    block_rows: int = 500_000,
    per_block: int = 10_000,
    max_blocks: int | None = None,
) -> DataFrame:
    """The sample at `sample_path`; if it is missing, it is drawn from the CSV by way of Parquet.

    The Parquet copy is parsed once and keeps the order of the CSV rows. Blocks run through the
    whole table, so the sample does not depend on how the CSV or the copy is divided into files.
    """

    def build() -> DataFrame:
        cached_table(spark, trips_path, lambda: read_trips_csv_in_order(spark, csv_path))
        picked = block_sample(read_positioned(spark, trips_path), "position", block_rows, per_block, max_blocks)
        return feature_table(labelled_trips(picked))

    return cached_table(spark, sample_path, build)
