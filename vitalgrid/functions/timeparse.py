"""Timestamp parsing and local-time to UTC conversion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Layouts of the raw device exports.
HEART_RATE_FORMAT = "MM/dd/yy HH:mm:ss"
STEPS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
SLEEP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SAMPLE_FORMAT = "dd-MM-yyyy HH:mm"
KNOWN_FORMATS = (HEART_RATE_FORMAT, STEPS_FORMAT, SLEEP_FORMAT, SAMPLE_FORMAT)
LOCAL_ZONE = "Asia/Kolkata"

HAS_OFFSET = r"\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$"


def parse_timestamp(text: Column, formats=KNOWN_FORMATS) -> Column:
    """First layout that fits, then the general parser; anything else is null.

    The wall-clock time is kept as if it were UTC (session zone is UTC).
    """
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries, text.try_cast("timestamp"))


def local_to_utc(naive: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in ``zone`` to UTC.

    A time that occurs twice is null; a skipped time moves to the first instant
    after the skip (found on a 15-minute raster, where zone changes happen).
    """
    utc = F.to_utc_timestamp(naive, zone)
    back = F.from_utc_timestamp(utc, zone)
    twice = F.lit(False)
    for minutes in (30, 60, 120):
        later = F.timestamp_micros(F.unix_micros(utc) + F.lit(minutes * 60_000_000))
        twice = twice | (F.from_utc_timestamp(later, zone) == naive)
    offset_after = F.unix_micros(back) - F.unix_micros(utc)
    raster = F.timestamp_seconds(F.floor(F.unix_seconds(utc) / 900) * 900)
    candidates = F.sequence(raster - F.expr("INTERVAL 3 HOURS"), raster, F.expr("INTERVAL 15 MINUTES"))
    first_valid = F.element_at(
        F.filter(candidates,
                 lambda t: F.unix_micros(F.from_utc_timestamp(t, zone)) - F.unix_micros(t) == offset_after),
        1)
    return (F.when(back != naive, first_valid)
            .when(twice, F.lit(None).cast("timestamp"))
            .otherwise(utc))


def parse_to_utc(text: Column, formats=KNOWN_FORMATS, zone: str = LOCAL_ZONE) -> Column:
    """Parse text to a UTC timestamp; text with its own offset is not shifted again."""
    parsed = parse_timestamp(text, formats)
    return F.when(text.rlike(HAS_OFFSET), parsed).otherwise(local_to_utc(parsed, zone))
