"""Surrogate keys, date keys and the fixed instants of the model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must stay as they are for keys and intervals to agree with
# tables written before.
OPEN_END = "9999-12-31 23:59:59"
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_TEXT = "yyyyMMdd"
KEY_SEPARATOR = "_"


def open_end() -> Column:
    """End of a version that is still valid."""
    return F.to_timestamp(F.lit(OPEN_END))


def as_date(day: str | dt.date) -> dt.date:
    """A run date given as text or as a date; anything else is refused."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    return dt.date.fromisoformat(day)


def day_start(day: str | dt.date) -> Column:
    """Midnight of a run date, as a timestamp literal Catalyst folds."""
    return F.to_timestamp(F.lit(f"{as_date(day).isoformat()} 00:00:00"))


def render_timestamp(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_TEXT)


def version_key(natural: Column, start: Column) -> Column:
    """Key of one Type-2 version: md5 of ``<id>_<start of the version>``."""
    return F.md5(
        F.concat_ws(KEY_SEPARATOR, natural.cast("string"), render_timestamp(start))
    )


def id_key(natural: Column) -> Column:
    """Key of a Type-1 row: md5 of the id as text."""
    return F.md5(natural.cast("string"))


def date_key(day: Column) -> Column:
    """Day as the integer YYYYMMDD."""
    return F.date_format(day, DATE_KEY_TEXT).cast("int")
