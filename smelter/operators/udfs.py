"""User-defined functions; native expressions stay the first choice.

The Python functions are local to their builders, so Spark sends them to the
executors by value and the package need not be installed there.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the share of a price that is left after the discount.
SALE_SHARE = 0.9


def discount(price: Column | str, share: float = SALE_SHARE) -> Column:
    """Discounted price, in Arrow batches."""
    def sale(prices: pd.Series) -> pd.Series:
        return prices * share

    return F.pandas_udf(sale, "double")(price)


def discount_row(price: Column | str, share: float = SALE_SHARE) -> Column:
    """Discounted price, row by row; Arrow carries the rows."""
    def sale(value):
        return None if value is None else value * share

    return F.udf(sale, "double", useArrow=True)(price)
