"""Numeric helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column | str, digits: int) -> Column:
    """``ROUND(x, digits)`` with decimal half-up rounding, returned as double.

    One rounding, of the shortest decimal that stands for the double: 2.345 gives 2.35 and
    2.3449999996 gives 2.34.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits)
