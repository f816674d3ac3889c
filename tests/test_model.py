from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from conformance import fixtures
from tidefare.operators import predictions, regressor, trips
from tidefare.plans.training import run_training
from tidefare.session import scratch_path
from tidefare.sinks.tables import load_model, write_features
from tidefare.sources.tables import read_predictions_csv
from tidefare.sources.trips import read_features


@pytest.fixture(scope="module")
def trained(spark, gate):
    features, model, sample = (scratch_path(spark, name) for name in ("features", "model", "sample"))
    write_features(trips.feature_table(fixtures.clean_labelled(spark, gate), "trip_id"), features)
    result = run_training(spark, features, model, sample, "trip_id", trees=20, depth=8)
    return result, features, model, sample


def test_features_of_the_model():
    assert len(regressor.MODEL_FEATURES) == 15
    assert "fare_amount" not in regressor.MODEL_FEATURES
    assert regressor.MODEL_FEATURES[-3:] == ("is_morning_peak", "is_evening_peak", "is_late_night")


def test_defaults_of_the_forest():
    forest = regressor.surge_pipeline().getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 8, 42)


def test_one_pass_metrics_equal_the_evaluator(trained):
    result = trained[0]
    found = result.metrics.first()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert math.isclose(found[name], evaluator.evaluate(result.scored), rel_tol=1e-9)


def test_model_beats_the_mean(trained):
    spread = trained[0].scored.agg(F.stddev_pop("label")).first()[0]
    found = trained[0].metrics.first()
    assert found.rmse < 0.5 * spread
    assert found.r2 > 0.8


def test_importances(trained):
    rows = trained[0].importances.collect()
    assert [row.rank for row in rows] == list(range(1, 16))
    assert {row.feature for row in rows} == set(regressor.MODEL_FEATURES)
    assert math.isclose(sum(row.importance for row in rows), 1.0, rel_tol=1e-9)
    values = [row.importance for row in rows]
    assert values == sorted(values, reverse=True)
    assert all((row.band == "high") == (row.importance >= 0.15) for row in rows)
    assert regressor.importances(trained[0].model, top=8).count() == 8


def test_saved_model_scores_the_same(spark, trained):
    result, features, model_path, _ = trained
    rows = regressor.training_rows(read_features(spark, features, "trip_id")).limit(200)
    first = {r.trip_id: r.prediction for r in regressor.score(result.model, rows).collect()}
    second = {r.trip_id: r.prediction for r in regressor.score(load_model(model_path), rows).collect()}
    assert first == second


def test_predictions_sample(spark, trained):
    result, _, _, sample = trained
    stored = read_predictions_csv(spark, sample)
    assert stored.columns == ["label", "prediction", "hour", "day_of_week", "is_weekend"]
    # Fewer than 5,000 test rows: all of them are kept.
    assert stored.count() == result.scored.count()
    assert math.isclose(
        predictions.error_summary(stored).first().rmse, result.metrics.first().rmse, rel_tol=1e-9
    )


def test_rows_with_a_null_feature_are_skipped(trained):
    scored = trained[0].scored
    assert scored.filter("dropoff_longitude IS NULL").count() == 0


def test_axis_limits_and_residuals(spark):
    rows = spark.createDataFrame([(1.0, 1.2), (3.0, 2.5)], "label double, prediction double")
    limits = predictions.axis_limits(rows, pad=0.1).first()
    assert (round(limits.low, 9), round(limits.high, 9)) == (0.9, 3.1)
    residuals = [round(r.residual, 9) for r in predictions.with_residual(rows).collect()]
    assert residuals == [-0.2, 0.5]


def test_error_of_a_constant_label(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (1.0, 1.5)], "label double, prediction double")
    assert predictions.error_summary(rows).first().r2 is None
