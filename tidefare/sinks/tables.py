"""Batch sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tidefare.operators.predictions import prediction_columns
from tidefare.operators.sampling import DEFAULT_SEED, sample_key, seeded_sample
from tidefare.sources.tables import ROW_KEY


def write_features(features: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite the stored features.

    Without partitioning this is a map-only job. With it, the rebalance hint gathers each
    partition's rows into full-size files and lets AQE split a partition that is too large.
    """
    if partition_by is None:
        features.write.mode("overwrite").parquet(path)
    else:
        gathered = features.hint("rebalance", partition_by)
        gathered.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def write_cells(cells: DataFrame, path: str) -> None:
    """Overwrite the stored cells with one small file, made after the distributed aggregation."""
    cells.repartition(1).write.mode("overwrite").parquet(path)


def write_predictions_csv(scored: DataFrame, path: str, *keys: str, n: int = 5000) -> None:
    """Overwrite a seeded sample of predictions as CSV with a header; `row_key` is a hash of the keys."""
    sample = seeded_sample(scored, n, *keys).withColumn(ROW_KEY, sample_key(DEFAULT_SEED, *keys))
    prediction_columns(sample, ROW_KEY).write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
