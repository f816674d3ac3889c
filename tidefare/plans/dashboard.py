"""Dashboard job: every dataset behind one filtered view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidefare.operators import dashboard, fares, predictions
from tidefare.operators.cells import trip_cells
from tidefare.operators.dashboard import FilterSpec
from tidefare.operators.sampling import seeded_sample
from tidefare.sources.tables import cached_table


def stored_cells(spark: SparkSession, trips: DataFrame, path: str) -> DataFrame:
    """The cells at `path`, reduced from the trips the first time."""
    return cached_table(spark, path, lambda: trip_cells(trips).repartition(1))


def cell_datasets(cells: DataFrame, spec: FilterSpec | None = None) -> dict[str, DataFrame]:
    """The datasets that need cells only. An empty view gives empty datasets and null KPIs."""
    shown = dashboard.apply_filter(cells, spec or FilterSpec())
    return {
        "kpis": dashboard.kpis(shown),
        "hourly": dashboard.hourly_surge_dense(shown),
        "box": dashboard.surge_box_by_day(shown),
        "share": dashboard.surge_share(shown),
        "heatmap": dashboard.surge_heatmap_pivot(shown, all_days=False),
        "weekday_weekend": dashboard.weekday_weekend_hourly(shown),
        # The choices offered to the viewer do not depend on the current filter.
        "levels": dashboard.surge_levels(cells),
    }


def trip_datasets(
    named_trips: DataFrame, *keys: str, spec: FilterSpec | None = None
) -> dict[str, DataFrame]:
    """The datasets that show single trips (which carry `dow_monday` and `day_name`)."""
    shown = dashboard.apply_filter(named_trips, spec or FilterSpec())
    return {
        "preview": dashboard.trip_preview(shown, *keys),
        "fare_points": fares.fare_scatter(shown, *keys),
    }


def prediction_datasets(scored: DataFrame, *keys: str, n: int = 2000) -> dict[str, DataFrame]:
    """Prediction plots. The overall error ignores the viewer's filters."""
    points = predictions.prediction_columns(seeded_sample(scored, n, *keys), *keys)
    return {
        "overall_error": predictions.error_summary(scored),
        "points": points,
        "points_error": predictions.error_summary(points),
        "limits": predictions.axis_limits(points, pad=0.05),
        "preview": predictions.prediction_columns(seeded_sample(scored, 100, *keys), *keys),
    }
