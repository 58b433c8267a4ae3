"""Timestamps that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def instant(utc_wall_clock: str) -> Column:
    """A zoneless UTC wall-clock column as an instant.

    Put together from its date and time parts, since casts between the two kinds of
    timestamp go through the session time zone and its clock changes.
    """
    t = f"`{utc_wall_clock}`"
    seconds = f"unix_date(to_date({t})) * 86400L + hour({t}) * 3600 + minute({t}) * 60"
    return F.expr(f"timestamp_micros(({seconds}) * 1000000L + cast(extract(second from {t}) * 1000000 as bigint))")


def utc_label(instant_column: str) -> Column:
    """``yyyy-MM-ddTHH-mm-ss`` in UTC: sortable, and free of the colon that file names must not hold."""
    wall_clock = f"timestampadd(microsecond, unix_micros(`{instant_column}`), {_EPOCH})"
    return F.expr(f"translate(substr(cast({wall_clock} as string), 1, 19), ' :', 'T-')")
