"""Streaming jobs over a feed of request messages (one string column, `value`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidefare.sinks import streams
from tidefare.sinks.ledger import write_ledger
from tidefare.streaming.events import as_messages, price_events
from tidefare.streaming.matching import events_with_windows
from tidefare.streaming.replays import HORIZON, once_each
from tidefare.streaming.requests import (
    bad_records,
    parse_requests,
    parsed_requests,
    unparsed_records,
    valid_requests,
)
from tidefare.streaming.windows import LATENESS, WINDOW, window_surge


def start_window_surge(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "15 seconds",
    width: str = WINDOW,
    lateness: str = LATENESS,
    files: int | None = None,
) -> StreamingQuery:
    """Windowed surge per zone, upserted under `path`."""
    windows = window_surge(valid_requests(parse_requests(messages)), width, lateness)
    return streams.upsert_windows(windows, path, checkpoint, trigger, files)


def start_window_ledger(
    messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds", width: str = WINDOW, lateness: str = LATENESS
) -> StreamingQuery:
    """Windowed surge per zone with closed windows apart, late requests kept and lasting counts, in a `Ledger` at `path`."""
    return write_ledger(valid_requests(parse_requests(messages)), path, checkpoint, trigger, width, lateness)


def start_event_surge_files(
    messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds", horizon: str | None = None
) -> StreamingQuery:
    """Per-event surge of every message that parses, appended to files as keyed messages.

    With a `horizon`, such as `HORIZON`, a message that the feed repeats within it is priced once.
    """
    requests = parsed_requests(parse_requests(messages))
    priced = price_events(requests if horizon is None else once_each(requests, horizon))
    return streams.append_files(as_messages(priced), path, checkpoint, trigger)


def start_event_window_join(
    messages: DataFrame, again: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds", width: str = WINDOW, lateness: str = LATENESS
) -> StreamingQuery:
    """Every priced message with the surge of its window, appended to files once the window has closed; `again` is a second reading of the feed."""
    requests, feed = (valid_requests(parse_requests(side)) for side in (messages, again))
    return streams.append_files(events_with_windows(requests, feed, width, lateness), path, checkpoint, trigger)


def start_event_surge_kafka(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str = streams.SURGE_TOPIC,
    trigger: str | None = "1 second",
    horizon: str | None = None,
) -> StreamingQuery:
    """Per-event surge, published to Kafka with the zone as key; `horizon` as for files."""
    requests = parsed_requests(parse_requests(messages))
    priced = price_events(requests if horizon is None else once_each(requests, horizon))
    return streams.publish_kafka(as_messages(priced), servers, checkpoint, topic, trigger)


def start_bad_records(
    messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "15 seconds", timed: bool = True
) -> StreamingQuery:
    """Messages that the windows (`timed`) or the per-event job could not use, kept for inspection."""
    choose = bad_records if timed else unparsed_records
    return streams.append_files(choose(parse_requests(messages)), path, checkpoint, trigger)
