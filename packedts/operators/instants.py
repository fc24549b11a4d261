"""Time values given by callers."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_utc(value: str | datetime) -> datetime:
    """An instant; text and datetimes without a zone are UTC."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def instant(value: str | datetime) -> Column:
    return F.lit(as_utc(value).isoformat()).cast("timestamp")


def utc_day(time: Column) -> Column:
    """UTC date of an instant, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))
