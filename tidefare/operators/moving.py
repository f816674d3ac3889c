"""Moving demand: sums and means over the minutes before each request.

A frame of the last half hour needs only rows of that half hour. Every zone is cut into slots of time, a
row goes to its own slot and, if the next slot's frames reach back to it, there as well, marked as
context. So a zone that holds most of the rows is spread over its slots, and no frame crosses a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FRAME_MINUTES, SLOT_MINUTES = 30, 24 * 60


def moving_demand(requests: DataFrame, frame_minutes: int = FRAME_MINUTES, slot_minutes: int = SLOT_MINUTES) -> DataFrame:
    """Each request with the requests, total demand and mean drivers of its zone in the `frame_minutes` up to it, itself and its instant included.

    Requests without a time are left out; those without a zone are one zone. Take `slot_minutes` down
    where a zone has more rows in a slot than a task can sort; it must not be below `frame_minutes`.
    """
    if slot_minutes < frame_minutes:
        raise ValueError("a slot must be as long as the frame")
    micros_of = 60_000_000
    timed = requests.where(F.col("event_time").isNotNull()).withColumn("micros", F.unix_micros("event_time"))
    slot = F.floor(F.col("micros") / (slot_minutes * micros_of))
    next_slot = F.floor((F.col("micros") + frame_minutes * micros_of) / (slot_minutes * micros_of))
    # One copy, or two if the next slot's first frames begin before this row.
    dealt = timed.withColumn("slot", F.explode(F.sequence(slot, next_slot))).withColumn("own", F.col("slot") == slot)
    frame = W.partitionBy("zone", "slot").orderBy("micros").rangeBetween(-frame_minutes * micros_of, 0)
    return (
        dealt.withColumns({
            "recent_requests": F.count(F.lit(1)).over(frame),
            "recent_demand": F.sum("ride_requests").over(frame),
            "recent_drivers": F.avg("available_drivers").over(frame),
        })
        .where("own").drop("micros", "slot", "own")
    )
