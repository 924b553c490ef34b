"""Column helpers for JSON text and times on the wire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: packet times look like 2024-01-31T12:00:00.250Z and are UTC.
PACKET_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"


def json_object(text: Column) -> Column:
    """A JSON object as ``map<string, string>``; NULL for anything else.

    Nested values stay JSON text. Numbers given as strings read the same as
    plain numbers, which a typed schema would turn into NULL.
    """
    return F.from_json(text, "map<string,string>")


def packet_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(PACKET_TIME_FORMAT))


def whole_number(text: Column) -> Column:
    """BIGINT of a number text; a fraction is cut off."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


# Years 1 to 9999 in epoch seconds; times outside would overflow further on.
MIN_SECOND, MAX_SECOND = -62135596800, 253402300799


def epoch_seconds(text: Column) -> Column:
    """Timestamp of an epoch-seconds text; NULL when it is no usable time."""
    seconds = whole_number(text)
    return F.when(seconds.between(MIN_SECOND, MAX_SECOND), F.timestamp_seconds(seconds))


def epoch_millis(text: Column) -> Column:
    """Timestamp of an epoch-milliseconds text; NULL when it is no usable time."""
    millis = whole_number(text)
    usable = millis.between(MIN_SECOND * 1000, MAX_SECOND * 1000)
    return F.when(usable, F.timestamp_millis(millis))
