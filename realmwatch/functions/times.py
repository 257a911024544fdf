"""Epoch-second arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from realmwatch.schemas import DAY_SECONDS


def day_start(epoch: Column) -> Column:
    """First second of the UTC day an epoch falls in."""
    return epoch - F.pmod(epoch, F.lit(DAY_SECONDS).cast("bigint"))


def day_label(epoch: Column) -> Column:
    """UTC day as yyyy-MM-dd text, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(epoch / DAY_SECONDS).cast("int")).cast("string")


def iso_epoch(stamp: Column, offset: Column) -> Column:
    """Epoch seconds of an ISO date-time and its offset; a missing offset means UTC.

    NULL when the text names no instant.
    """
    zone = F.when(offset == "", "Z").otherwise(offset)
    return F.unix_seconds(F.concat(stamp, zone).try_cast("timestamp"))
