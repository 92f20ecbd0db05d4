"""Timestamp parsing for feed items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(col: Column) -> Column:
    """ISO-8601 with offset or Z; junk gives null (instant, as UTC)."""
    return _try_cast_ts(col)


def _try_cast_ts(col: Column) -> Column:
    s = F.regexp_replace(F.trim(col), r"Z$", "+00:00")
    return F.when(F.length(s) > 0, s.try_cast("timestamp"))


def iso_local_date(col: Column) -> Column:
    """Calendar date in the item's own offset (the text's date part)."""
    ts = _try_cast_ts(col)
    return F.when(ts.isNotNull(), F.try_to_date(F.substring(F.trim(col), 1, 10)))


def parse_rfc822(col: Column) -> Column:
    """I4: 'Tue, 02 Jan 2024 10:00:00 +0000' (weekday optional) to a UTC instant."""
    s = F.regexp_replace(F.trim(col), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss xx")),
                      F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss z")),
                      F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm xx")))
