"""Date text and date parts as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAYS = ("MMMM d, yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "M/d/yyyy")
# a day, with or without a time after a space or a T
FORMATS = tuple(f"{day}[['T'][ ]HH:mm[:ss[.SSSSSS]]]" for day in _DAYS)

# Julian date of 1970-01-01 00:00
UNIX_EPOCH_JULIAN = 2440587.5


def parse_moment(text: Column, formats: Sequence[str] = FORMATS) -> Column:
    """First format that fits, as a timestamp without zone; ordinal suffixes (4th) are dropped. Null if none fits."""
    plain = F.regexp_replace(F.trim(text), r"(\d+)(st|nd|rd|th)\b", "$1")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)).cast("timestamp_ntz") for f in formats])


def parse_date(text: Column, formats: Sequence[str] = FORMATS) -> Column:
    """The day of :func:`parse_moment`."""
    return parse_moment(text, formats).cast("date")


def julian(date: Column) -> Column:
    """Julian date of a date at midnight."""
    return F.unix_date(date) + F.lit(UNIX_EPOCH_JULIAN)


def julian_timestamp(moment: Column) -> Column:
    """Julian date with the time of day, whatever the session time zone."""
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60
    micros = seconds.cast("bigint") * 1_000_000 + (F.date_part(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")
    whole = F.unix_date(moment.cast("date")).cast("bigint") * 86_400_000_000 + micros
    return whole / F.lit(86_400_000_000.0) + F.lit(UNIX_EPOCH_JULIAN)


def packed_unpadded(date: Column) -> Column:
    """Year, month and day written next to each other without padding; 2015-01-11 and 2015-11-01 coincide."""
    return F.concat(F.year(date), F.month(date), F.dayofmonth(date)).cast("bigint")


def packed(date: Column) -> Column:
    """yyyymmdd as a number, without collisions."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("bigint")


def date_parts(moment: Column, prefix: str) -> dict[str, Column]:
    """Julian date with the time of day, year, month, day and unpadded packed number, named by ``prefix``."""
    return {
        f"{prefix}_julian": julian_timestamp(moment),
        f"{prefix}_year": F.year(moment),
        f"{prefix}_month": F.month(moment),
        f"{prefix}_day": F.dayofmonth(moment),
        f"{prefix}_raw": packed_unpadded(moment),
    }
