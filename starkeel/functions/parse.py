"""Typed reading of text fields that never fails a job.

Spark's ANSI mode raises on a bad value. A feed with one bad cell must not stop
the day, so every field is parsed to NULL on failure and the failure stays
visible through :func:`malformed`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse(raw: Column, to: T.DataType) -> Column:
    """``raw`` as type ``to``, NULL where the text does not fit.

    Days and instants outside the years 1 to 9999 do not fit either: they have no
    date key, and Python cannot hold them.
    """
    if isinstance(to, T.StringType):
        return raw
    value = raw.try_cast(to)
    if isinstance(to, (T.DateType, T.TimestampType)):
        value = F.when(F.year(value).between(1, 9999), value)
    return value


def malformed(raw: Column, to: T.DataType) -> Column:
    """True where a value is present but cannot be read as ``to``."""
    if isinstance(to, T.StringType):
        return F.lit(False)
    return raw.isNotNull() & parse(raw, to).isNull()
