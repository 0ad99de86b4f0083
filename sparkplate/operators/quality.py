"""Data-quality checks and counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """The non-null values of ``col`` that occur more than once, with their count ``n``.

    Partial aggregation counts each value inside every task first, so a value held by a
    third of the rows costs one partial row per task, not one shuffle row per record.
    """
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """The rows whose ``col`` is null (empty result = test passes)."""
    return df.where(F.col(col).isNull())


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """One row, one ``bigint`` count; no action is run here."""
    return df.agg(F.count(F.lit(1)).alias(name))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for many tables in one result (UNION ALL)."""
    parts = [row_count(df).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
