"""Row-level data-quality flags and reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smelter.functions.typing import as_column


def is_positive(c: Column | str) -> Column:
    """True for a value over zero; NULL counts as not valid."""
    return F.coalesce(as_column(c) > 0, F.lit(False))


def first_reason(checks: dict[str, Column]) -> Column:
    """Name of the first check that is not true, NULL when all hold."""
    return F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    )
