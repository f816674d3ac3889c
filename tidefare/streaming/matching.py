"""Priced requests with the surge of their zone's window: a join of two streams, or of two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefare.streaming.events import price_events
from tidefare.streaming.windows import LATENESS, WINDOW, demand_windows, priced_windows


def _zone_key() -> Column:
    """The zone as a value that equals itself where it is null, and no zone's name."""
    return F.coalesce(F.concat(F.lit("="), F.col("zone")), F.lit(""))


def events_with_windows(requests: DataFrame, feed: DataFrame, width: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Every request as priced on its own, with the ratio and surge of the window that holds it.

    `feed` is the same feed, read a second time for the windows. In a stream, output mode append, both sides keep
    state: windows until the watermark closes them, requests until it passes their window. A closed window
    meets its requests by zone and window, an equality, so the join is a hash join, and the window's end is the
    time range that lets both sides leave the state. Requests later than the watermark are dropped on both sides alike.
    """
    # A stream's side has one event time: the window. The request's own time goes along as a plain value.
    own = requests.withColumn("requested_at", F.col("event_time")).withWatermark("event_time", lateness).withColumn("own_window", F.window("event_time", width))
    events = price_events(own.withColumn("zone_key", _zone_key()), None, "own_window", "zone_key", "requested_at")
    windows = demand_windows(feed, width, lateness)
    surges = priced_windows(windows.withColumn("zone_key", _zone_key()), "window", "zone_key").select(
        "window", F.col("zone_key").alias("window_zone"), "total_requests",
        F.col("demand_supply_ratio").alias("window_ratio"), F.col("surge_multiplier").alias("window_surge"),
    )
    matched = events.join(surges, (F.col("own_window") == F.col("window")) & (F.col("zone_key") == F.col("window_zone")))
    return matched.drop("own_window", "zone_key", "window_zone").withColumns({
        "window_start": F.col("window.start"), "window_end": F.col("window.end"),
    }).drop("window")
