"""Dates, times and elapsed time. No function reads the clock by itself."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.text import as_column

# The zone audit stamps are written in, and their format.
WALL_CLOCK_ZONE = "Asia/Jakarta"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

_AGO = r"(?i)\b(\d+|an?)\s+(second|minute|hour|day|week|month|year)s?\s+ago\b"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _micros(wall: Column) -> Column:
    """Microseconds since 1970 of a zone-less time.

    Put together from its fields: the difference functions would read the time
    in the session's zone, where some hours are missing or come twice.
    """
    minutes = F.unix_date(F.to_date(wall)).cast("bigint") * 1440 + F.hour(wall) * 60 + F.minute(wall)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")


def utc_instant(wall: Column | str) -> Column:
    """Instant of a zone-less time that is meant in UTC, whatever the session's zone."""
    return F.timestamp_micros(_micros(as_column(wall).cast("timestamp_ntz")))


def utc_wall(instant: Column | str) -> Column:
    """Zone-less UTC time of an instant; goes by the clock count, so no hour is ambiguous."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_column(instant)), _epoch())


def wall_clock(instant: Column | None = None, zone: str = WALL_CLOCK_ZONE) -> Column:
    """Local wall-clock time of an instant, without a zone."""
    instant = F.current_timestamp() if instant is None else instant
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall(instant))


def wall_clock_stamp(instant: Column | None = None, zone: str = WALL_CLOCK_ZONE) -> Column:
    return F.date_format(wall_clock(instant, zone), STAMP_FORMAT)


def parse_published(text: Column | str, reference: Column | str) -> Column:
    """Publication time out of ``'8 years ago'`` or an absolute date.

    Relative forms count back from ``reference`` (the time the page was read,
    not the time of the run). Unreadable text gives null. English units only.
    """
    c, ref = as_column(text), as_column(reference).cast("timestamp_ntz")
    amount = F.regexp_extract(c, _AGO, 1)
    unit = F.lower(F.regexp_extract(c, _AGO, 2))
    n = F.when(F.lower(amount).isin("a", "an"), F.lit(1)).otherwise(amount.try_cast("int"))

    def back(name: str) -> Column:
        return F.when(unit == name, n).otherwise(F.lit(0))

    shifted = ref - F.make_interval(
        back("year"),
        back("month"),
        back("week"),
        back("day"),
        back("hour"),
        back("minute"),
        back("second").cast("decimal(18,6)"),
    )
    return F.when(unit != "", shifted).otherwise(c.try_cast("timestamp_ntz"))


def release_date(text: Column | str, precision: Column | str) -> Column:
    """Date of a release given to the year, the month or the day."""
    c, p = as_column(text), as_column(precision)
    whole = (
        F.when(p == "year", F.concat(c, F.lit("-01-01")))
        .when(p == "month", F.concat(c, F.lit("-01")))
        .otherwise(c)
    )
    return F.try_to_date(whole, "yyyy-MM-dd")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds between two zone-less times, fractions cut off."""
    a, b = (as_column(c).cast("timestamp_ntz") for c in (start, end))
    span = _micros(b) - _micros(a)
    return ((span - span % 1_000_000) / 1_000_000).cast("bigint")
