"""The most frequent pickup areas of a grid too fine to count in full.

A frequent-items summary of `TRACKED` areas is merged from all tasks: it holds every area of more than
`ERROR_FACTOR` / `TRACKED` of the trips. One more pass counts the tracked areas alone, exactly, with
their means. If the last of the top areas has more trips than any untracked one can have, the answer is exact and
proven; only on a grid so flat that it has not, all areas are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefare.functions.numbers import steady_round
from tidefare.operators.local import rows_of

TRACKED = 10_000
#: An area that the summary does not list has at most this many trips, times all trips over `TRACKED`: twice the
#: 3.5 that the summary may miss a count by.
ERROR_FACTOR = 7


def _grid_steps(coordinate: str, digits: int) -> Column:
    return F.round(F.col(coordinate) * 10**digits).cast("long")


def top_areas(trips: DataFrame, digits: int = 4, top: int = 15, tracked: int = TRACKED) -> DataFrame:
    """The `top` pickup areas of `digits` decimals by trips, then coordinates, with mean surge and fare.

    Trips without a pickup place have no area. The summary's areas, at most `tracked`, are broadcast.
    """
    span = 1000 * 10**digits
    # One number for an area: steps of latitude are below half a span either way.
    area = (_grid_steps("pickup_longitude", digits) * span + _grid_steps("pickup_latitude", digits)).alias("area")
    placed = trips.select(area, "surge_multiplier", "fare_amount").where(F.col("area").isNotNull())
    summary = placed.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(area, {tracked}, {tracked})").alias("found")).first()
    found = summary["found"] or []  # at most `tracked` areas
    candidates = rows_of(trips.sparkSession, "area: bigint", [{"area": row["item"]} for row in found])
    counted = _counted(placed.join(F.broadcast(candidates), "area"), digits, span, top)
    if sum(row["count"] for row in found) == summary["rows"]:
        return counted  # nothing was left out
    last = counted.agg(F.min("total_trips").alias("least"), F.count(F.lit(1)).alias("areas")).first()
    proven = last["areas"] == top and last["least"] > ERROR_FACTOR * summary["rows"] / tracked
    return counted if proven else _counted(placed, digits, span, top)


def _counted(placed: DataFrame, digits: int, span: int, top: int) -> DataFrame:
    latitude = F.pmod(F.col("area") + F.lit(span // 2), F.lit(span)) - F.lit(span // 2)
    return (
        placed.groupBy("area")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            steady_round(F.avg("surge_multiplier"), 3).alias("avg_surge"),
            steady_round(F.avg("fare_amount"), 2).alias("avg_fare"),
        )
        .select(
            ((F.col("area") - latitude) / F.lit(span) / F.lit(float(10**digits))).alias("area_lon"),
            (latitude / F.lit(float(10**digits))).alias("area_lat"), "total_trips", "avg_surge", "avg_fare",
        )
        .orderBy(F.desc("total_trips"), "area_lon", "area_lat")
        .limit(top)
    )
