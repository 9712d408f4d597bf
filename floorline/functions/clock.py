"""Event time: parsing, calendar parts, shifts of the day and local wall clocks.

Calendar parts follow the session time zone, which ``session`` pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from floorline.functions.labels import first_match

# Parts of the day by hour (both ends included), and the plant's zone.
DAY_PARTS = (("Morning", 6, 13), ("Evening", 14, 21))
NIGHT = "Night"
LOCAL_ZONE = "Africa/Cairo"


def parse_event_time(text: str = "timestamp") -> Column:
    """ISO-8601 text as a timestamp; text that is none becomes null, also under ANSI."""
    return F.try_to_timestamp(F.col(text))


def event_date(ts: str = "timestamp") -> Column:
    return F.to_date(F.col(ts))


def event_hour(ts: str = "timestamp") -> Column:
    return F.hour(F.col(ts))


def time_bucket(ts: str = "timestamp") -> Column:
    hour = F.hour(F.col(ts))
    return first_match([(hour.between(start, end), part) for part, start, end in DAY_PARTS], NIGHT)


def wall_clock(ts: str, zone: str = LOCAL_ZONE) -> Column:
    """The local date and time of an instant, without a zone; follows summer time."""
    return F.convert_timezone(None, F.lit(zone), F.col(ts).cast("timestamp_ntz"))
