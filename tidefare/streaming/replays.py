"""Messages that a feed delivers more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How long a replay may come after its message, in event time.
HORIZON = "1 hour"


def once_each(requests: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Each request once, by `event_id`; the same for streams and tables.

    A stream keeps an id until the watermark, `horizon` behind the newest event time, has passed its event
    time by `horizon`, so the state holds about two horizons of ids whatever the stream's age. A request older than
    the watermark is dropped: it is a replay, or came later than the horizon allows, and counts among the
    rows dropped as late. Requests without an id or without a time cannot be told from others and all pass.
    """
    known = F.col("event_id").isNotNull() & F.col("event_time").isNotNull()
    named = requests.where(known)
    if requests.isStreaming:
        named = named.withWatermark("event_time", horizon).dropDuplicatesWithinWatermark(["event_id"])
    else:
        named = named.dropDuplicates(["event_id"])
    return named.unionByName(requests.where(~known))
