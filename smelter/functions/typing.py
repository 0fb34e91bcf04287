"""String-to-typed conversions that give NULL instead of an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """``'N/A'`` and ``'NaN'`` both become NULL: neither is a usable amount."""
    value = as_column(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_int(c: Column | str) -> Column:
    return as_column(c).try_cast("int")


def to_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(as_column(c), fmt)


def to_timestamp(c: Column | str) -> Column:
    """A wall-clock time (no time zone), so its hour does not depend on the session's zone."""
    return as_column(c).try_cast("timestamp_ntz")


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without a time zone."""
    return F.unix_micros(as_column(c).cast("timestamp"))


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(as_column(c).cast("timestamp"))
