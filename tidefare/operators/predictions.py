"""Comparing predictions with labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefare.schemas import PREDICTIONS


def with_residual(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residual", F.col("label") - F.col("prediction"))


def error_summary(predictions: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 in one pass."""
    residual = F.col("label") - F.col("prediction")
    spread = F.var_pop("label") * F.count("label")
    return predictions.agg(
        F.sqrt(F.avg(residual * residual)).alias("rmse"),
        F.avg(F.abs(residual)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(residual * residual), spread)).alias("r2"),
        F.count(residual).alias("rows"),
    )


def axis_limits(predictions: DataFrame, pad: float = 0.1) -> DataFrame:
    """Common limits of the label and prediction axes."""
    return predictions.agg(
        (F.least(F.min("label"), F.min("prediction")) - F.lit(pad)).alias("low"),
        (F.greatest(F.max("label"), F.max("prediction")) + F.lit(pad)).alias("high"),
    )


def prediction_columns(scored: DataFrame, *keys: str) -> DataFrame:
    """The stored prediction columns, after any key columns that are not among them."""
    stored = PREDICTIONS.fieldNames()
    return scored.select(*[key for key in keys if key not in stored], *stored)
