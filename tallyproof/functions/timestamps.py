"""Strict dates and timestamps; impossible ones are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/Sao_Paulo"


def local_iso(date: Column, time: Column) -> Column:
    """``yyyyMMdd`` and ``HHmmss`` in the business zone as ISO text with its offset, whatever the session's zone."""
    shape = date.rlike(r"^\d{8}\z") & time.rlike(r"^\d{6}\z")
    wall = F.when(shape, F.try_to_timestamp(F.concat(date, time), F.lit("yyyyMMddHHmmss"))).cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit(ZONE), F.lit("UTC"), wall)
    minutes = F.timestamp_diff("MINUTE", utc, wall)
    hours = F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0")
    rest = F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0")
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), F.when(minutes < 0, "-").otherwise("+"), hours, F.lit(":"), rest)


def strict_offset(raw: Column) -> Column:
    """ISO text with an offset as a timestamp; a zero offset must be written Z."""
    shape = raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})\z") & ~raw.rlike(r"[+-]00:00\z")
    return F.when(shape, F.try_to_timestamp(raw))


def strict_date(raw: Column, pattern: str = "dd/MM/yyyy") -> Column:
    """A date whose text comes back unchanged when written again."""
    date = F.try_to_date(raw, pattern)
    return F.when(F.date_format(date, pattern) == raw, date)
