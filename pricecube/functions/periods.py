"""Half-year period labels ('YYYY-S1' / 'YYYY-S2')."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of(period: Column) -> Column:
    """Year as INT from the first four characters.

    A plain (ANSI) cast: a malformed label fails the job instead of being
    silently dropped, as the original pipeline does.
    """
    return F.left(period, F.lit(4)).cast("int")


def in_year_range(period: Column, start: int, end: int) -> Column:
    return year_of(period).between(F.lit(start), F.lit(end))
