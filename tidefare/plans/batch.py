"""Batch job: raw trips to stored features, stored cells and the demand reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidefare.operators import demand, trips
from tidefare.operators.cells import trip_cells
from tidefare.sinks.tables import write_cells, write_features
from tidefare.sources.trips import read_features

CELL_REPORTS = {
    "surge_by_hour": demand.surge_by_hour,
    "weekend_vs_weekday": demand.weekend_vs_weekday,
    "surge_percentiles": demand.surge_percentiles,
    "peak_hour_windows": demand.peak_hour_windows,
}


@dataclass(frozen=True)
class BatchResult:
    raw_rows: int
    clean_rows: int
    features: DataFrame
    cells: DataFrame
    reports: dict[str, DataFrame]


def run_batch(
    raw: DataFrame, out: str, *keys: str, view: str = "trips", partition_by: str | None = None
) -> BatchResult:
    """Write `out`/features in one pass over the raw trips, then `out`/cells from six of its columns.

    Clean rows are observed during the first write. Raw rows are counted on their own: observing
    them in the same scan would keep the cleaning filters from reaching it. Over Parquet that
    count reads no columns.
    The reports read the cells; only the pickup areas need the stored trips again. The feature
    table is also registered as a view for SQL.
    """
    spark = raw.sparkSession
    features_path, cells_path = f"{out}/features", f"{out}/cells"
    clean_seen = Observation("clean")
    kept = trips.labelled_trips(raw).observe(clean_seen, F.count(F.lit(1)).alias("rows"))
    write_features(trips.feature_table(kept, *keys), features_path, partition_by)
    features = read_features(spark, features_path, *keys)
    features.createOrReplaceTempView(view)
    write_cells(trip_cells(features), cells_path)
    cells = spark.read.parquet(cells_path)
    return BatchResult(
        raw_rows=raw.count(),
        clean_rows=clean_seen.get["rows"],
        features=features,
        cells=cells,
        reports={
            "top_pickup_areas": demand.top_pickup_areas(features),
            **{name: report(cells) for name, report in CELL_REPORTS.items()},
        },
    )
