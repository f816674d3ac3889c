"""Training job: stored features to a saved model, metrics, importances and sample predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tidefare.operators import predictions, regressor
from tidefare.operators.sampling import train_test_split
from tidefare.sinks.tables import save_model, write_predictions_csv
from tidefare.sources.trips import read_features


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    scored: DataFrame
    metrics: DataFrame
    importances: DataFrame


def train_surge_model(
    features: DataFrame, *keys: str, trees: int = 100, depth: int = 8, seed: int = 42
) -> TrainingResult:
    """Fit on the training part and score the rest."""
    train, test = train_test_split(regressor.training_rows(features), *keys, seed=seed)
    model = regressor.fit(train, trees, depth, seed)
    scored = regressor.score(model, test)
    return TrainingResult(
        model, scored, predictions.error_summary(scored), regressor.importances(model)
    )


def run_training(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    predictions_path: str,
    *keys: str,
    trees: int = 100,
    depth: int = 8,
) -> TrainingResult:
    """Train from the stored features and save the model and 5,000 sample predictions."""
    result = train_surge_model(
        read_features(spark, features_path, *keys), *keys, trees=trees, depth=depth
    )
    save_model(result.model, model_path)
    sample_keys = keys or tuple(
        name for name in (*regressor.MODEL_FEATURES, "fare_amount", "label")
    )
    write_predictions_csv(result.scored, predictions_path, *sample_keys)
    return result
