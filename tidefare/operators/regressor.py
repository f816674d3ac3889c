"""The surge regressor: a random forest over the stored features and period flags."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefare.functions import surge
from tidefare.functions.calendar import FLAG_HOURS
from tidefare.operators.local import rows_of
from tidefare.operators.trips import with_period_flags
from tidefare.schemas import FEATURE_COLUMNS

#: At least so many parts, and one for so many rows.
TRAINING_PARTS, ROWS_IN_PART = 32, 500_000

# The fare is not a feature; the surge is the label.
MODEL_FEATURES = (
    *[name for name in FEATURE_COLUMNS if name not in ("fare_amount", "surge_multiplier")],
    *FLAG_HOURS,
)


def training_rows(features: DataFrame) -> DataFrame:
    """Feature rows with period flags and a known `label`."""
    return (
        with_period_flags(features)
        .filter(F.col("surge_multiplier").isNotNull())
        .withColumnRenamed("surge_multiplier", "label")
    )


def surge_pipeline(trees: int = 100, depth: int = 8, seed: int = 42) -> Pipeline:
    """Assembler and forest. Rows with a null feature are skipped."""
    assembler = VectorAssembler(
        inputCols=list(MODEL_FEATURES), outputCol="features", handleInvalid="skip"
    )
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[assembler, forest])


def settled(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows dealt by content into sorted parts, as many as their number asks for.

    Bagging and split sampling follow partitions and their order, so this makes the forest the
    same for any file layout and number of cores.
    """
    parts = parts or max(TRAINING_PARTS, -(-rows.count() // ROWS_IN_PART))
    return rows.repartition(parts, *rows.columns).sortWithinPartitions(*rows.columns)


def fit(
    train: DataFrame, trees: int = 100, depth: int = 8, seed: int = 42, parts: int | None = None
) -> PipelineModel:
    """Fit on the needed columns only; the forest keeps its own binned copy on memory and disk.

    The number of parts, which grows with the rows, is part of what decides the model.
    """
    needed = train.select(*MODEL_FEATURES, "label")
    return surge_pipeline(trees, depth, seed).fit(settled(needed, parts))


def skipped_rows(rows: DataFrame) -> DataFrame:
    """How many rows the model skips because a feature is null."""
    some_null = reduce(or_, (F.col(name).isNull() for name in MODEL_FEATURES))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(some_null).alias("skipped"))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def importances(model: PipelineModel, top: int | None = None) -> DataFrame:
    """Named feature importances of a fitted model with band and rank, highest first."""
    forest = model.stages[-1]
    pairs = zip(MODEL_FEATURES, forest.featureImportances.toArray().tolist(), strict=True)
    ranked = sorted(pairs, key=lambda pair: (-pair[1], pair[0]))
    frame = rows_of(
        SparkSession.active(),
        "rank: int, feature: string, importance: double",
        [
            {"rank": rank, "feature": name, "importance": value}
            for rank, (name, value) in enumerate(ranked[:top], start=1)
        ],
    )
    return frame.withColumn("band", surge.importance_band(F.col("importance"))).orderBy("rank")
