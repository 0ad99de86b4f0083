"""The weighted (Bayesian) rating formula (F16)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_rating(v: Column | str, r: Column | str, m: Column | str, c: Column | str) -> Column:
    """``v/(v+m) * R + m/(v+m) * C``: votes ``v``, item mean ``R``, vote floor ``m``,
    global mean ``C``. With no votes and no floor (``v + m = 0``) there is nothing to weigh:
    the score is null."""
    v, r, m, c = (F.col(x) if isinstance(x, str) else x for x in (v, r, m, c))
    return F.try_divide(v, v + m) * r + F.try_divide(m, v + m) * c
