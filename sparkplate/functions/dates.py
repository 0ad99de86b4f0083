"""Calendar expressions (F1-F8, F13) and the date spine."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_spine(spark: SparkSession, begin: str, end: str, name: str = "CalendarDate",
               num_partitions: int = 1) -> DataFrame:
    """One row per day from ``begin`` to ``end``, both ends included.

    The days are generated from ``spark.range`` over the day offsets; a calendar is a few
    thousand rows, ``num_partitions`` spreads a longer one.
    """
    days = (date.fromisoformat(end) - date.fromisoformat(begin)).days
    return (spark.range(0, days + 1, 1, num_partitions)
            .select(F.date_add(F.to_date(F.lit(begin)), F.col("id").cast("int")).alias(name)))


def day_of_week_iso(c: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday (F2); Spark's ``dayofweek`` starts on Sunday."""
    return (F.weekday(_c(c)) + 1).cast("bigint")


def date_key(c: Column | str) -> Column:
    """``yyyymmdd`` as an integer."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def fiscal_year(c: Column | str, start_month: int) -> Column:
    """Fiscal year that starts in ``start_month``: next calendar year from that month on (F8)."""
    d = _c(c)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d)).cast("bigint")


def fiscal_month(c: Column | str, start_month: int) -> Column:
    """Month number within a fiscal year starting in ``start_month`` (F8).

    ``start_month`` 10 gives ``(month + 2) % 12 + 1``, 7 gives ``(month + 5) % 12 + 1``.
    """
    shift = 12 - start_month
    return ((F.month(_c(c)) + shift) % 12 + 1).cast("bigint")


def month_start(c: Column | str) -> Column:
    """Month grain of a timestamp held as text (F13); the cast is required because the
    silver layer keeps review dates as strings. Malformed text gives null (its own month
    group), not an error."""
    return F.to_date(F.date_trunc("month", F.try_to_timestamp(_c(c))))
