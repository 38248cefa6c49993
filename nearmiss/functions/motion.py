"""Per-ping motion and time helpers as Spark Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def course_change(cog, prev_cog) -> Column:
    """Smallest angle between two courses in degrees, rounded to 2 decimals.

    ``|cog − prev|``, folded over 180°; 0.0 when either course is missing.
    """
    d = F.abs(_col(cog) - _col(prev_cog))
    return F.round(
        F.when(d.isNull(), F.lit(0.0)).when(d > 180.0, F.lit(360.0) - d).otherwise(d), 2
    )


def speed_change(sog, prev_sog) -> Column:
    """Speed change in knots rounded to 2 decimals; null on the first ping."""
    return F.round(_col(sog) - _col(prev_sog), 2)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 00:00:00. Zone-free for TIMESTAMP_NTZ input,
    instant-based for TIMESTAMP input."""
    return F.unix_timestamp(_col(ts))


def time_bucket(ts, seconds: int) -> Column:
    """Tumbling, epoch-aligned bucket number ``floor(epoch / seconds)`` (long)."""
    return F.floor(epoch_seconds(ts) / F.lit(seconds)).cast("long")


def truncate_to_second(ts) -> Column:
    """Drop the sub-second part of a TIMESTAMP_NTZ without touching time zones."""
    c = _col(ts)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.second(c)
    )
