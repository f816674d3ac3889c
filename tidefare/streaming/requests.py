"""Messages to typed requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.schemas import RIDE_REQUEST

_CORRUPT = "unparsed"


def parse_requests(messages: DataFrame) -> DataFrame:
    """Columns of each JSON message in `value`, `event_time`, and whether the message `parsed`.

    Text that is no JSON of the expected types does not parse; a message without a time does.
    Parsing sits in a generator so that it runs once per message: filters on the columns would
    otherwise carry a copy of it.
    """
    schema = T.StructType([*RIDE_REQUEST.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    fields = F.inline(F.array(F.from_json("value", schema, options)))
    derived = F.struct(
        F.try_to_timestamp("timestamp").alias("event_time"),
        (F.col(_CORRUPT).isNull() & (F.trim(F.coalesce("value", F.lit(""))) != "")).alias("parsed"),
    )
    return messages.select("value", fields).select("*", F.inline(F.array(derived))).drop(_CORRUPT)


def valid_requests(requests: DataFrame) -> DataFrame:
    """Parsed requests with a usable time: what windows can count."""
    return requests.filter(F.col("parsed") & F.col("event_time").isNotNull()).drop("value", "parsed")


def parsed_requests(requests: DataFrame) -> DataFrame:
    """All parsed requests, with or without a time: what is priced one by one."""
    return requests.filter("parsed").drop("value", "parsed")


def bad_records(requests: DataFrame) -> DataFrame:
    """The raw text of messages that windows cannot count."""
    return requests.filter(~F.col("parsed") | F.col("event_time").isNull()).select("value")


def unparsed_records(requests: DataFrame) -> DataFrame:
    """The raw text of messages that do not parse."""
    return requests.filter("NOT parsed").select("value")
