"""Ride sessions: requests of one user with no longer pause than a gap; the same for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = "30 minutes"
LATENESS = "2 minutes"


def ride_sessions(requests: DataFrame, user: str = "user_id", gap: str = GAP, lateness: str = LATENESS) -> DataFrame:
    """Start, end, requests, zones and demand of every session.

    A session ends `gap` after its last request; a request at that very instant still belongs to it. In a
    stream a session leaves the state, and is sent once, when the watermark passes its end; state
    merges as requests arrive between two sessions. Requests without a time are left out, those without a user are one user.
    """
    return (
        requests.where(F.col("event_time").isNotNull()).withWatermark("event_time", lateness)
        .groupBy(F.session_window("event_time", gap).alias("session"), F.col(user).alias("user_id"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.sum("ride_requests").alias("total_requests"),
            F.min(F.struct("event_time", "zone"))["zone"].alias("first_zone"),
            F.max(F.struct("event_time", "zone"))["zone"].alias("last_zone"),
        )
        .select("user_id", F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
                "requests", "total_requests", "first_zone", "last_zone")
    )
