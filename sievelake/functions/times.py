"""Points in time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: Column | datetime | str | None = None) -> Column:
    """The processing time: the given one, else the time of the batch."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def utc(stamp: Column) -> Column:
    """The wall clock of UTC at an instant, whatever the zone of the session."""
    return F.to_utc_timestamp(stamp, F.current_timezone())


def iso_text(stamp: Column) -> Column:
    """ISO 8601 text in UTC with offset; the fraction is left out when it is zero."""
    whole = F.date_format(utc(stamp), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fine = F.date_format(utc(stamp), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.date_trunc("second", stamp) == stamp, whole).otherwise(fine)
